"""Operators without an SQL form, against brute force, exact round trips or held-out accuracy."""

import collections
import pathlib
import tempfile
import time
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from feedlake.llm import common, html_text, mixing, quality, similar, suffix_dedup, tokens, url_rules, words

TOKENIZER = "word_bpe_49k.json"


@pytest.fixture(scope="module")
def vocabulary():
    return pytest.importorskip("public_tokenizers").path(TOKENIZER)


def by_file(spark, out):
    return [f.split("/")[-1] for f in sorted(spark.read.parquet(out).inputFiles())]


# --- operator 1

def expected_ids(lib, rows):
    start, out = 0, []
    for doc_id, text in rows:
        ids = [*lib.encode(text or "", add_special_tokens=False).ids, 1]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("table", ["documents", "odd"])
def test_tokens_equal_whole_text_encoding(request, vocabulary, table):
    from tokenizers import Tokenizer

    docs = request.getfixturevalue(table)
    rows = sorted(((r.doc_id, r.text) for r in docs.collect()), key=lambda r: (r[0] is not None, r[0]))
    got = [tuple(r) for r in tokens.encode_and_digest(docs, vocabulary).collect()]
    assert sorted(got, key=lambda r: r[1]) == expected_ids(Tokenizer.from_file(vocabulary), rows)


def test_tokens_of_another_vocabulary(documents):
    from tokenizers import Tokenizer

    path = pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")
    docs = documents.filter("doc_id < 40")
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    got = sorted(map(tuple, tokens.encode_and_digest(docs, path).collect()))
    assert got == expected_ids(Tokenizer.from_file(path), rows)


def test_small_caches_change_nothing(monkeypatch, documents, vocabulary):
    monkeypatch.setattr(tokens, "CHUNK_CACHE", 50)
    monkeypatch.setattr(tokens, "PIECE_CACHE", 20)
    enc = tokens.Encoder(vocabulary)
    for r in documents.limit(30).collect():
        assert enc.encode([r.text.encode()])[0] == np.array(enc.lib.encode(r.text, add_special_tokens=False).ids, "<u4").tobytes()


def test_pieces_of_odd_strings(vocabulary):
    """Contractions, apostrophes, digits, Latin-1 letters, other scripts, special tokens, control characters in any order."""
    import random

    enc, rng = tokens.Encoder(vocabulary), random.Random(4)
    parts = ["a", "B", "s", "t", "re", "ve", "ll", "m", "d", "'", "'", "'s", "’", ".", ",", "1", "23", "É", "ß", "×", "÷", "ÿ", "漢", "é",
             "<|", "<|endoftext|>", "|>", " ", " ", "\t", "\n", "\x0b", "İ", "\x00", "\x1c", "½", "ǅ", "Σ", "ς", "힣", "e\u0301"]
    for _ in range(2000):
        x = "".join(rng.choice(parts) for _ in range(rng.randint(0, 25)))
        want = np.array(enc.lib.encode(x, add_special_tokens=False).ids, "<u4").tobytes()
        assert enc.encode([x.encode(), b"", x.encode()]) == [want, b"", want], x


def test_colliding_hashes_change_nothing(monkeypatch, vocabulary):
    monkeypatch.setattr(tokens, "span_hashes", lambda raw, starts, ends: (ends - starts).astype(np.uint64))
    enc, x = tokens.Encoder(vocabulary), "Some words, some others; it's 12 ways."
    assert enc.encode([x.encode()]) == [np.array(enc.lib.encode(x, add_special_tokens=False).ids, "<u4").tobytes()]


def test_spans_are_compared_by_whole_bytes():
    texts = [b"ab", b"abcdefgh", b"abcdefghijklmnopq", "\u65e5\u672c\u8a9e".encode() * 9]
    for x in texts:
        data = np.frombuffer(x + b" " + x + b" ", np.uint8)
        a, b, n = np.array([0, 0]), np.array([0, len(x) + 1]), np.array([len(x), len(x)])
        assert tokens.same_spans(data, a, b, n) and tokens.same_spans(data, b, a, n)
        for at in range(len(x)):
            other = data.copy()
            other[len(x) + 1 + at] ^= 1
            assert not tokens.same_spans(other, a, b, n) and not tokens.same_spans(other, b, a, n)
    h = np.array([5, 1 << 63, 5, 0, 1 << 63], np.uint64)
    first, which = tokens._distinct(h)
    assert h[first].tolist() == [0, 5, 1 << 63] and (h[first][which] == h).all()


def test_strange_chunks_are_found_where_few_and_where_many():
    plain, odd = b"some words 12 it's ", "caf\u00e9 \u65e5\u672c <|x a<|b ".encode()
    for text in (plain * 50 + odd, odd * 50 + plain, odd, plain, b" "):
        _, first, last, kind = tokens.split_units(np.frombuffer(text + b" ", np.uint8))
        strange = {text[a:b] for a, b, k in zip(first.tolist(), last.tolist(), kind.tolist()) if not k}
        assert strange == ({"\u65e5\u672c".encode(), b"<|x", b"a<|b"} if odd in text else set())


def test_token_files(spark, documents, vocabulary, tmp_path):
    out = str(tmp_path / "ids")
    tokens.write_tokens(documents, vocabulary, out)
    files = sorted((tmp_path / "ids").glob("*.parquet"))
    last = -1
    for f in files:
        meta = pq.ParquetFile(f).metadata
        ids = [c for c in range(meta.num_columns) if meta.schema.column(c).path.startswith("ids")][0]
        for g in range(meta.num_row_groups):
            column = meta.row_group(g).column(ids)
            assert set(column.encodings) & {"RLE_DICTIONARY", "DELTA_BINARY_PACKED"} and column.has_column_index
        order = pq.read_table(f, columns=["doc_id"])["doc_id"].to_pylist()
        assert order == sorted(order) and (not order or order[0] > last)
        last = order[-1] if order else last
    index = tokens.read_index(spark, out).orderBy("doc_id").collect()
    assert [r.start for r in index] == [0, *np.cumsum([r.n_tokens for r in index])[:-1].tolist()]
    some = tokens.read_tokens(spark, out, 10, 12)
    assert sorted(r.doc_id for r in some.collect()) == [10, 11, 12]
    plan = some._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(doc_id,10)" in plan
    assert "ids" not in tokens.read_index(spark, out)._jdf.queryExecution().optimizedPlan().toString().split("file_start")[0]


# --- operator 2

def test_quality_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    scored = quality.score_documents(docs, labels)
    rows = scored.join(labels, "doc_id").collect()
    assert scored.count() == docs.count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1
        assert r.predicted == int(r.score >= 0.3)
    fold = [r for r in rows if r.held_out]
    assert np.mean([r.predicted == r.quality for r in fold]) >= 0.95


def test_quality_ignores_the_held_out_fold(documents, spark, sf):
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    flipped = labels.withColumn("quality", F.when(quality.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = quality.train(documents, labels), quality.train(documents, flipped)
    assert np.allclose(a.mean, b.mean) and a.prior == b.prior and np.allclose(a.factors, b.factors)


def test_quality_matches_direct_density():
    rng = np.random.default_rng(0)
    d = len(quality.FEATURES)
    data = {0: rng.normal(1, 2, (200, d)), 1: rng.normal(0, 1, (300, d))}
    model = quality.fit({k: (len(x), x.sum(0), x.T @ x) for k, x in data.items()}, 0.0, 0.0)
    x = rng.normal(0.5, 1.5, (20, d))
    logs = []
    for k in (0, 1):
        mu, cov = data[k].mean(0), np.cov(data[k].T, bias=True)
        diff = x - mu
        logs.append(np.log(len(data[k]) / 500) - 0.5 * np.einsum("ij,jk,ik->i", diff, np.linalg.inv(cov), diff)
                    - 0.5 * np.linalg.slogdet(cov)[1])
    assert np.allclose(model.score(x), 1 / (1 + np.exp(logs[0] - logs[1])), atol=1e-6)


def test_quality_odd_rows(spark, odd, odd_rows, no_docs):
    labels = spark.createDataFrame([(1, 0, 0), (3, 0, 0), (7, 1, 0), (10, 1, 0), (None, 1, 0), (11, None, 0), (12, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    rows = quality.score_documents(odd, labels).collect()
    assert len(rows) == len(odd_rows) and all(0 <= r.score <= 1 for r in rows)
    assert quality.score_documents(no_docs, labels).collect() == []
    none = quality.score_documents(odd, labels.filter("false")).collect()
    assert {r.score for r in none} == {1.0}
    one = quality.filter_documents(odd, labels.filter("quality = 0"))
    assert one.columns == odd.columns and one.count() == 0


# --- operator 3

def targets_by_rounds(sizes, share=1.5):
    """The stated rule, literally: share by weight, stop at twice the size, reshare the excess."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target = dict.fromkeys(order, 0.0)
    left, free = share * sum(sizes.values()), set(order)
    while free:
        part = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if part[s] > 2 * sizes[s]]
        if not over:
            return target | part
        for s in over:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
            free.discard(s)
    return target


def test_mixing(documents):
    out = mixing.mix(documents).collect()
    source = {r.doc_id: r.source for r in documents.collect()}
    text = {r.doc_id: r.text for r in documents.collect()}
    sizes, taken, target = collections.Counter(), collections.Counter(), {}
    for r in out:
        assert r["size"] == len((text[r.doc_id] or "").encode().split()) and 0 <= r.taken <= 2 * r["size"]
        assert r.taken == r.copies * r["size"]
        sizes[source[r.doc_id]] += r["size"]
        taken[source[r.doc_id]] += r.taken
        target[source[r.doc_id]] = r.target
    want = targets_by_rounds(sizes)
    assert all(abs(want[s] - target[s]) < 1e-6 * max(want[s], 1) for s in sizes)
    # documents are taken whole, so a source can miss by part of a document
    assert all(abs(taken[s] - target[s]) <= max(0.05 * target[s], 60) for s in sizes), [(s, taken[s], target[s]) for s in sizes]
    assert sorted(map(tuple, out)) == sorted(map(tuple, mixing.mix(documents).collect()))


def test_rates_solve_the_dual(spark):
    """lambda gives sum(n * size * min(2, exp(lambda * size / mean))) = target, for tight and loose targets."""
    hist = spark.createDataFrame([(s, size, n) for s in "abcd" for size, n in ((1, 5), (3, 7), (10, 9), (200, 2))],
                                 "source string, size long, n long")
    whole = 5 + 21 + 90 + 400
    goals = {"a": 0.05, "b": 0.8, "c": 1.3, "d": 1.99}
    targets = spark.createDataFrame([(i, s, whole, whole / 23, False, whole * goals[s]) for i, s in enumerate("abcd")],
                                    "sid int, source string, source_size long, mean double, full boolean, target double")
    for r in mixing.solve_rates(hist, targets).collect():
        got = sum(n * size * min(2, np.exp(r.lam * size / (whole / 23))) for size, n in ((1, 5), (3, 7), (10, 9), (200, 2)))
        assert abs(got - whole * goals["abcd"[r.sid]]) < 1e-5 * whole


def test_mixing_odd_rows(odd, odd_rows, no_docs):
    out = mixing.mix(odd).collect()
    assert len(out) == len(odd_rows) and all(0 <= r.taken <= 2 * r["size"] for r in out)
    assert mixing.mix(no_docs).collect() == []
    rows = mixing.mix_rows(odd)
    assert rows.columns == odd.columns
    copies = collections.Counter(r.doc_id for r in rows.collect())
    want = collections.Counter()
    for r in out:
        want[r.doc_id] += r.copies
    assert copies == +want


@pytest.mark.parametrize("share", [0.75, 1.3])
def test_mixing_with_one_very_long_document(spark, share):
    """Copies by rising place, then the largest that fit, written out; a long document or repeated rows stop nothing."""
    rows = [(i, s, "w " * (90 + i % 21)) for s, n in (("a", 0), ("b", 2000)) for i in range(n, n + 700)]
    rows += [(9000, "a", "w " * 140_000), (9001, "b", "w " * 30_000)] + [(100, "b", "w " * 100)] * 300
    table = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(4)
    sized = mixing.written(mixing.sized_rows(table), "test-sized")
    params, repeated = mixing.plan(sized, weights=(1.0,), share=share)
    places, target = collections.defaultdict(collections.Counter), {}
    for r in mixing._rated(sized, params, 2).collect():
        assert not r.full
        target[r.source] = r.target
        for j in (1, 2):
            places[r.source][j - r.rate - r.v, j, r.v, r.doc_id] += r["size"]
    want = collections.Counter()
    for source, units in places.items():
        left = limit = int(target[source])
        walk = sorted(u for u in units.items() if u[1] <= limit)
        while walk and walk[0][1] <= left:
            (*_, doc), mass = walk.pop(0)
            left -= mass
            want[source, doc] += 1
        for (_, j, v, doc), mass in sorted(walk, key=lambda u: (-u[1], u[0][1] + u[0][2])):
            if mass <= left:
                left -= mass
                want[source, doc] += 1
        assert left < 90
    out = mixing.decide(sized, params, repeated).collect()
    assert all(r.copies == want[r.source, r.doc_id] for r in out)
    copies = collections.Counter((r.doc_id, r.source) for r in mixing.mix_rows(table, weights=(1.0,), share=share).collect())
    n = collections.Counter((d, s) for d, s, _ in rows)
    assert copies == +collections.Counter({k: n[k] * want[k[1], k[0]] for k in n})


# --- operator 4

def components_by_brute_force(rows, k, percent):
    sets = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[j:j + k]) for j in range(max(len(w) - k + 1, 1))} if w else set()
    up = {i: i for i in sets}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[x + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                a1, b1 = top(a), top(b)
                up[max(a1, b1)] = min(a1, b1)
    return {i: (len(sets[i]), top(i)) for i in ids}


def mesh(n, length, edits, seed):
    """Copies of one text with random edits: pairs around the threshold, links that no single leader has."""
    rng = np.random.default_rng(seed)
    base = [f"w{i}" for i in range(length)]
    out = []
    for i in range(n):
        w = list(base)
        for j in rng.choice(length, rng.integers(0, edits + 1), replace=False):
            w[j] = f"e{i}_{j}"
        out.append((i, " ".join(w)))
    return out


@pytest.mark.parametrize("n,length,edits,k,percent", [(60, 90, 4, 3, 90), (60, 40, 3, 5, 80), (40, 14, 2, 3, 90)])
def test_join_finds_every_component(spark, n, length, edits, k, percent):
    rows = mesh(n, length, edits, 3)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in similar.join(docs, k, percent).collect()}
    assert got == components_by_brute_force(rows, k, percent)


def test_join_of_costly_buckets(spark, monkeypatch):
    """All pairs left to the exhaustive step, with buckets large enough for the deletion index."""
    monkeypatch.setattr(similar, "LEADERS", 1)
    monkeypatch.setattr(similar, "COMPARISON_COST", 1)
    rows = mesh(150, 16, 3, 5)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in similar.join(docs, 3, 90).collect()}
    assert got == components_by_brute_force(rows, 3, 90)


def test_overlapping_groups_send_a_member_once(spark):
    """30 sets in 20 groups of 27 each are compared as one group; small groups around one set stay as they are."""
    dense = [(g, n) for g in range(20) for n in range(30) if n % 10 != g % 10]
    hub = [(100 + g, n) for g in range(12) for n in (1000, 2000 + 2 * g, 2001 + 2 * g)]
    k = collections.Counter(g for g, _ in dense + hub)
    rows = [(g, n, 50, n, k[g]) for g, n in dense + hub]
    got = similar._overlapping(spark.createDataFrame(rows, "sig long, node long, n long, comp long, k long").repartition(3)).collect()
    assert all((r.n, r.comp) == (50, r.node) for r in got)
    assert sorted(r.node for r in got if r.node < 1000) == list(range(30))
    assert sorted((r.sig, r.node) for r in got if r.node >= 1000) == sorted(hub)

    def pairs(members):
        groups = collections.defaultdict(set)
        for g, n in members:
            groups[g].add(n)
        return {(a, b) for m in groups.values() for a in m for b in m if a < b}

    assert pairs(dense + hub) <= pairs((r.sig, r.node) for r in got)


def test_written_leaves_no_shuffle_files(spark):
    top = spark.sparkContext.getConf().get("spark.local.dir", tempfile.gettempdir())

    def found():
        return {str(f) for f in pathlib.Path(top).glob("**/blockmgr-*/*/shuffle_*.data")}

    before = found()
    out = common.written(spark.range(1000).groupBy((F.col("id") % 7).alias("x")).count(), "shuffled")
    deadline = time.time() + 20
    while found() - before and time.time() < deadline:
        time.sleep(0.2)
    assert not found() - before
    assert out.agg(F.sum("count")).first()[0] == 1000
    assert spark.conf.get(common.SHUFFLE_CLEANUP) == "false"


@pytest.mark.parametrize("percent", [80, 90])
def test_signatures_are_complete(percent):
    """Any two sets at the threshold share an exact signature and a deletion signature."""
    rng = np.random.default_rng(percent)
    for n in [*range(5, 60), 100, 250, 900]:
        for _ in range(6):
            pool = rng.integers(0, 2**63, 3 * n, dtype=np.int64).view(np.uint64)
            a = np.unique(pool[:n])
            lose = int(rng.integers(0, n // 3 + 1))
            b = np.unique(np.concatenate((a[lose:], pool[n:n + int(rng.integers(0, n // 3 + 1))])))
            both = len(np.intersect1d(a, b))
            if 100 * both < percent * (len(a) + len(b) - both) or len(a) == len(b) == both:
                continue
            (ea, na, ka), (eb, nb, kb) = similar.exact_signatures(a, percent), similar.exact_signatures(b, percent)
            skips = dict(zip(na.tolist(), ka.tolist())), dict(zip(nb.tolist(), kb.tolist()))
            common = [n for x, n in zip(ea, na) if x in set(eb)]
            assert any(common.count(n) > max(skips[0].get(n, 0), skips[1].get(n, 0)) for n in set(common))
            (wa, la), (wb, lb) = similar.deletion_signatures(a, percent), similar.deletion_signatures(b, percent)
            assert set(wa) & (set(wb) | set(lb)) or set(wb) & set(la)


def test_word_hashes_follow_the_words():
    texts = [b"", b" \t ", "Éa b\tC  d e".encode(), b"x", b"A b a B a b", b"a\x0bb\x0c c\x1cd", b"z" * 100_000]
    seen = {}
    for t in texts:
        h, _ = words.word_hashes([t])
        w = t.lower().split()
        assert len(h) == len(w)
        for x, y in zip(w, h.tolist()):
            assert seen.setdefault(x, y) == y
    assert len(set(seen.values())) == len(seen)


# --- operator 7

HTML = [
    (None, ""), ("", ""), ("<script>var a='<p>no</p>'</script>", ""), ("just text", "just text"),
    ("<html><head><title>t</title></head><body><nav><a href=/>Home</a></nav><article><h1>A &amp; B</h1><p>One,  two\n three."
     "<p>Four &copy; <b>fi</b>ve.<br>Six<form><input>no</form></article><footer>&copy; x</footer>", "A & B\nOne, two three.\nFour © five. Six"),
    ("<body><div class='sidebar widget'><p>Side text, long enough, with commas, to score.</p></div><div id=main><h2>T</h2>"
     "<p>Body text, long enough, with commas, to score well, and more of it here.</p><ul><li>a<li>b</ul></div>"
     "<div class='comments'><p>I agree, fully, with all, of this, indeed.</p></div></body>",
     "T\nBody text, long enough, with commas, to score well, and more of it here.\na\nb"),
    ("<article><header><h1>Kept</h1></header><p>a < b & c</p><aside>no</aside><div hidden>no</div></article>", "Kept\na < b & c"),
    ("<p>never closed <i>at <b>all", "never closed at all"),
    ("<div role=banner>Site</div><div class=cookie-notice>We use cookies</div><main><p>Text.</p></main>", "Text."),
]


def test_main_text():
    for html, want in HTML:
        assert html_text.main_text(html) == want, html
    assert html_text.main_text("<div>" * 5000 + "deep" + "</div>" * 5000) == "deep"
    assert len(html_text.main_text("<article><p>" + "word, " * 50_000 + "</article>")) == 299_999


LONG = "A sentence of the article, with a comma, that is long enough to count. " * 8


@pytest.mark.parametrize("attrs", ['href="/hidden-gems"', 'title="the hidden cost"', 'data-hidden="false"', 'data-id="sidebar"',
                                   "data-x='class=\"header\"'", 'title="style=display:none"', "href=/a?id=nav"])
def test_attributes_are_read_by_full_name(attrs):
    for tag in ("p", "div", "a"):
        assert html_text.main_text(f"<body><article><p>{LONG}</p><{tag} {attrs}>kept text</{tag}></article></body>").endswith("kept text")


@pytest.mark.parametrize("attrs", ["hidden", "HIDDEN=''", 'class="x" hidden', "aria-hidden='true'", 'style="display: none"',
                                   'class="x"hidden', 'class="site-header"', "id=nav", 'role = "navigation"'])
def test_what_is_hidden_or_named_stays_out(attrs):
    assert html_text.main_text(f"<body><article><p>{LONG}</p><div {attrs}>lost text</div></article></body>") == LONG.strip()


@pytest.mark.parametrize("name", ["post with-sidebar", "no-sidebar", "has-comments", "page nav-open"])
def test_a_wrapper_named_by_its_layout_stays(name):
    text, side = LONG.strip(), '<div class="sidebar">side text</div><div class="post-comments"><p>first comment</p></div>'
    for page in (f'<body><div class="{name}"><p>{LONG}</p>{side}</div></body>',
                 f'<body><main><div class="{name}"><p>{LONG}</p></div></main>{side}</body>',
                 f'<body><div class="{name}"><article><p>{LONG}</p></article>{side}</div><div>{LONG * 2}</div></body>',
                 f'<body><div class="{name}"><div id="{name}"><main><p>{LONG}</p>{side}</main></div></div></body>'):
        assert html_text.main_text(page) == text, page
    # comments longer than the article are still comments, also if each is an article element
    for talk in (f"<p>{LONG * 3}</p>", f"<article><p>{LONG * 2}</p></article>" * 2):
        assert html_text.main_text(f'<body><article><p>{LONG}</p></article><div class="comments">{talk}</div></body>') == text


def test_extract(spark, sf):
    import re
    from html import unescape

    pages = spark.read.parquet(f"{sf}/pages.parquet")
    html = {r.page_id: r.html for r in pages.collect()}
    out = html_text.extract(pages.withColumn("text", F.lit("clash"))).collect()
    assert len(out) == len(html)
    for r in out:  # in these pages the article element holds the article and nothing else
        body = re.search(r"<article>(.*?)(?:</article>|$)", html[r.page_id], re.S)[1].replace("<br>", " ")
        parts = (re.sub(r"<[^>]*>", "", b) for b in re.split(r"</?(?:p|h1)>", body))
        assert r.text == "\n".join(b for b in (" ".join(unescape(p).split()) for p in parts) if b) and r.n_chars == len(r.text)
    odd = spark.createDataFrame([(None, None, None), (1, "u", "")], "page_id long, url string, html string")
    assert [(r.text, r.n_chars) for r in html_text.extract(odd).collect()] == [("", 0), ("", 0)]
    assert html_text.extract(odd.limit(0)).collect() == []


@pytest.mark.parametrize("shape", [
    "<a '" * 250_000, "<!" * 400_000, "<b>" * 5000 + "</i>" * 200_000, "</a" * 300_000, "<a \"<b '" * 120_000,
    "".join(f"<div>text {i}, here" for i in range(30_000)), "<p><div>" + "<b>" * 5000 + "<hr>" * 150_000,
    "<b>" * 5000 + "<tr></tr>" * 100_000, "<thead>" * 5000 + "<li></li>" * 100_000, "<header>" * 100_000 + "x"])
def test_hostile_pages_take_linear_time(shape):
    import time

    def took(html):
        t = time.process_time()
        html_text.main_text(html)
        return time.process_time() - t

    assert took(shape) < 12


def test_a_page_inside_one_form():
    text = "The article has words, and a comma. " * 9
    page = f"<body><form action=x><div><p>{text}</p><input value=a><button>Go</button></div></form></body>"
    assert html_text.main_text(page) == text.strip()
    page = f"<body><div><p>{text}</p></div><form><p>Your name, please, and mail</p></form></body>"
    assert html_text.main_text(page) == text.strip()


def test_tags_as_browsers_read_them():
    assert html_text.main_text('<p title="a < b > c">one</p><p>2 < 3 and 4 > 1</p>') == "one\n2 < 3 and 4 > 1"
    assert html_text.main_text("<article><ul><li>a<li>b</ul><p>c<p>d<div>e</b></div></article>") == "a\nb\nc\nd\ne"


def test_repeated_pages(spark):
    pages = spark.createDataFrame([(1, "u", "<p>one</p>", "clash")] * 3 + [(2, "v", None, "clash")], "page_id long, url string, html string, text string")
    assert sorted(tuple(r) for r in html_text.extract(pages).collect()) == [(1, "u", "one", 3)] * 3 + [(2, "v", "", 0)]


# --- operator 8

def judged(url):
    """Host, path and fixed rule, written out."""
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host, rest = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut]), rest[cut:]
        path = rest[:min([rest.find(c) for c in "?#" if c in rest] or [len(rest)])]
    fits = [(len(h + p), h + p, v) for h, p, v in url_rules.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *max(fits)[1:]) if fits else (host, path, None, None)


URLS = [None, "", "no scheme", "http://", "http://COM/", "https://a.example.COM/en/x?y#z", "http://www.example.com/en/",
        "http://x.www.example.com/en/1", "ftp://net/es/", "http://a.net/ES/", "http://notcom/x", "http://a.com", "http://a.com?x=/",
        "x://y://z.com/a", "http://É.net/fr/ü\n2", "http://example.com/en"]


def token_rows(df):
    host, path = url_rules.host_of(F.col("url")), url_rules.path_of(F.col("url"))
    return df.select("page_id", "url", url_rules.tokens(F.col("url"), host, path).alias("tokens"))


def test_urls_against_brute_force(spark, sf):
    """Fixed rules by hand; mined rules by counting every token subset of the labelled URLs."""
    from itertools import combinations

    pages = spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url")
    pages = pages.unionByName(spark.createDataFrame(list(enumerate(URLS, 10**6)), "page_id long, url string"))
    pages = pages.withColumn("host", F.lit("clash"))
    sets = {r.page_id: frozenset(r.tokens) for r in token_rows(pages).collect()}
    fixed = {r.page_id: judged(r.url) for r in pages.collect()}
    labelled = [(sets[i], f[3]) for i, f in fixed.items() if f[3]]
    least = int(np.ceil(url_rules.MIN_SUPPORT * len(labelled)))
    count, block = collections.Counter(), collections.Counter()
    for items, verdict in labelled:
        for k in range(1, len(items) + 1):
            for c in combinations(sorted(items), k):
                count[c] += 1
                block[c] += verdict == "block"
    rules = [set(c) for c in count if block[c] >= least and block[c] / count[c] >= url_rules.MIN_CONFIDENCE]
    assert rules
    out = url_rules.judge(pages).collect()
    assert len(out) == pages.count()
    for r in out:
        host, path, rule, verdict = fixed[r.page_id]
        want = verdict or ("block" if any(x <= sets[r.page_id] for x in rules) else "allow")
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, rule, want)


def test_mining_ends_on_shared_query_keys(spark):
    """Twenty query keys that always come together, in blocked and allowed URLs: subsets are not listed."""
    keys = "&".join(f"k{i}=1" for i in range(20))
    urls = [f"http://a{i % 7}.net/es/p?{keys}" for i in range(200)] + [f"http://b{i % 5}.com/x?{keys}" for i in range(150)]
    urls += [f"http://c{i % 5}.net/es/q?only=1&{keys}" for i in range(50)]
    urls += [f"http://d.org/es/z?{keys}", "http://d.org/y?only=2", "http://d.org/x?k3=1", "http://d.org/y?k3=1&only=1"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.page_id: r.verdict for r in url_rules.judge(pages.unionByName(pages.limit(3))).collect()}
    assert [got[len(urls) - i] for i in (4, 3, 2, 1)] == ["block", "block", "allow", "block"]


def test_equal_tokens_stand_for_their_class(spark):
    """Rules of two classes fire with any member of each."""
    rows = [(f"1-{i % 3}", ["a", "b", "x", "y"], "block") for i in range(30)] + [("2", ["a", "b", "z"], "allow")] * 10
    rows += [("3", ["x", "y", "w"], "allow")] * 10
    mined, classes = url_rules.mine(spark.createDataFrame(rows, "id string, tokens array<string>, verdict string"), 0.05, 0.8)
    rules = sorted((r.tokens, round(r.confidence, 3)) for r in mined.collect())
    assert rules == [(["a", "x"], 1.0)]
    urls = spark.createDataFrame([(1, ["b", "y"]), (2, ["a"]), (3, ["y", "x"]), (4, ["a", "b", "x"]), (5, ["q"])], "id long, tokens array<string>")
    assert sorted(r.id for r in url_rules.matches(urls, mined, classes).collect()) == [1, 4]


def test_urls_without_labels(spark):
    pages = spark.createDataFrame([(1, "http://a.org/x"), (2, None)], "page_id long, url string")
    assert {r.verdict for r in url_rules.judge(pages).collect()} == {"allow"}
    assert url_rules.judge(pages.limit(0)).collect() == []


# --- operator 10: one key and text in very many rows

def test_hot_repeated_rows_are_dealt_out(spark):
    from feedlake.llm import sharding

    rows = spark.range(5000).select(F.lit(7).cast("bigint").alias("doc_id"), F.lit("same").alias("text"))
    rows = rows.unionByName(spark.range(100, 1100).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), "id").alias("text")))
    out = sharding.shard_documents(rows).collect()
    assert len(out) == 6000 and {r.shard for r in out if r.doc_id == 7}.__len__() == 1
    for shard in range(16):
        slots = sorted(r.slot for r in out if r.shard == shard)
        assert slots == list(range(len(slots)))
    kept = {r.doc_id: r.shard for r in out}
    assert all(r.grown_shard in (kept[r.doc_id], 16) for r in out) and any(r.grown_shard == 16 for r in out)
    whole = sharding.shard_rows(rows).filter("doc_id = 7").select("slot").distinct()
    assert whole.count() == 5000


# --- operator 9

def passages_by_brute_force(rows, n=50):
    places = collections.defaultdict(set)
    split = {i: (t or "").encode().lower().split() for i, t in rows if i is not None}
    for i, w in split.items():
        for j in range(len(w) - n + 1):
            places[tuple(w[j:j + n])].add(i)

    def merged(starts):
        out = []
        for s in starts:
            if out and s <= out[-1][1]:
                out[-1] = (out[-1][0], s + n)
            else:
                out.append((s, s + n))
        return out

    found = {}
    for i, w in split.items():
        where = [places[tuple(w[j:j + n])] for j in range(len(w) - n + 1)]
        spans = merged([j for j, p in enumerate(where) if len(p) > 1])
        if spans:
            found[i] = (spans, merged([j for j, p in enumerate(where) if min(p) < i]))
    return found


@pytest.mark.parametrize("table", ["documents", "odd"])
def test_repeated_passages(request, table):
    docs = request.getfixturevalue(table)
    want = passages_by_brute_force([(r.doc_id, r.text) for r in docs.collect()])
    assert want
    got = {r.doc_id: r for r in suffix_dedup.find(docs).collect()}
    assert {i: ([tuple(s) for s in r.spans], [tuple(s) for s in r.cut]) for i, r in got.items()} == want
    assert all(r.n_repeated == sum(b - a for a, b in r.spans) and r.n_cut == sum(b - a for a, b in r.cut) for r in got.values())


def test_passages_of_fifty_words(spark):
    """A shared run of 50 words is found wherever it stands; 49 words are not."""
    rng = np.random.default_rng(1)
    fresh = iter(range(10**6))
    run = [f"r{i}" for i in range(50)]
    rows = []
    for i in range(40):
        shared = run if i % 2 else run[:49]
        rows.append((i, " ".join([f"u{next(fresh)}" for _ in range(rng.integers(0, 90))] + shared + [f"u{next(fresh)}" for _ in range(rng.integers(0, 90))])))
    got = {r.doc_id: r.spans for r in suffix_dedup.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert set(got) == set(range(1, 40, 2)) and all(b - a == 50 for s in got.values() for a, b in s)


def test_matches_across_partitions(spark, monkeypatch):
    """A hot passage and copies that end in other partitions: more ranges than a lead has rows, and texts forgotten at once."""
    monkeypatch.setattr(suffix_dedup, "SEEN", 0)
    run = [f"r{i % 60}" for i in range(70)]
    rows = [(i, " ".join([f"u{i}-{j}" for j in range(i % 60)] + run + [f"v{i}-{j}" for j in range(i % 7)])) for i in range(40)]
    rows += [(100 + i, rows[0][1]) for i in range(5)] + [(200 + i, " ".join(f"w{i // 2}-{j}" for j in range(80)) + f" e{i}") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    want = passages_by_brute_force(rows)
    try:
        for n in (1, 150):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
            got = suffix_dedup.find(docs).collect()
            assert {r.doc_id: ([tuple(s) for s in r.spans], [tuple(s) for s in r.cut]) for r in got} == want
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_no_passages(no_docs):
    assert suffix_dedup.find(no_docs).collect() == []
