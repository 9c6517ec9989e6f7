"""Operators 11 to 13 against brute force, on the given tables and on odd rows."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedlake.llm import fingerprints, hard_negatives, periodic, queries

# --- operator 11


def brute_runs(w, shortest=6, exponent=4):
    """Every diagonal word by word."""
    out = {}
    for q in range(1, len(w) // exponent + 1):
        i = q
        while i < len(w):
            end = i
            while end < len(w) and w[end] == w[end - q]:
                end += 1
            if end > i and end - i + q >= max(shortest, exponent * q):
                out.setdefault((i - q, end - i + q), q)
            i = end + 1
    return sorted((s, n, q) for (s, n), q in out.items())


def test_runs_equal_every_diagonal():
    rng = random.Random(5)
    for _ in range(400):
        texts = []
        for _ in range(rng.randint(1, 4)):
            n, kinds = rng.choice([0, 1, 5, 30, 100, 400]), rng.choice([1, 2, 3, 10])
            w = [str(rng.randrange(kinds)).encode() for _ in range(n)]
            for _ in range(rng.randint(0, 3) if n > 10 else 0):
                a, p, length = rng.randrange(n), rng.randint(1, n // 4), rng.randint(0, n)
                for i in range(a + p, min(n, a + length)):
                    w[i] = w[i - p]
            texts.append(w)
        assert periodic.text_runs(texts) == [brute_runs(w) for w in texts]


@pytest.mark.parametrize("exponent,shortest", [(3, 2), (5, 40)])
def test_other_exponents(exponent, shortest):
    rng = random.Random(exponent)
    for _ in range(60):
        unit = [str(rng.randrange(3)).encode() for _ in range(rng.randint(1, 40))]
        w = [b"x"] * rng.randint(0, 9) + unit * rng.randint(1, 9) + unit[:rng.randint(0, len(unit))] + [b"y", b"z"]
        assert periodic.text_runs([w], shortest, exponent) == [brute_runs(w, shortest, exponent)]
    with pytest.raises(ValueError):
        periodic.find_runs(np.zeros(9, np.int64), 9, exponent=2)


def test_long_periodic_texts():
    """One word, a long unit of one word and a mark, and an overlap-free word: no diagonal is opened in vain."""
    n = 200_000
    assert periodic.text_runs([[b"a"] * n]) == [[(0, n, 1)]]
    runs = periodic.text_runs([([b"a"] * 499 + [b"b"]) * 400])[0]
    assert (0, n, 500) in runs and len(runs) == 401
    assert periodic.text_runs([[str(bin(i).count("1") % 2).encode() for i in range(1 << 16)]]) == [[]]


def test_collapse_keeps_first_period():
    words = b"x a b a b a b a b y".split()
    assert periodic.text_runs([words]) == [[(1, 8, 2)]]
    assert periodic.collapse(words, [(1, 8, 2)]) == b"x a b y".split()


def test_runs_of_odd_rows(odd, odd_rows, no_docs):
    got = periodic.find(odd, periodic.repeat_part)
    want = []
    for r in odd_rows:
        words = periodic.repeat_part(r[0], (r[1] or "").encode().split())
        runs = brute_runs(words) if len(words) < 5000 else None
        kept = None if runs is None else b" ".join(periodic.collapse(words, runs)).decode()
        want.append((r[0], len(words), runs, kept))
    rows = [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in got.collect()]
    key = lambda r: (str(r[0]), r[1])
    for a, b in zip(sorted(rows, key=key), sorted(want, key=key), strict=True):
        assert a[:2] == b[:2] and (b[2] is None or a == b)
    assert all(r.runs_sha256 and r.collapsed_sha256 for r in periodic.digest(got).collect())
    assert periodic.digest(periodic.find(no_docs)).collect() == []


# --- operator 12

def expected_prints(rows):
    """rows: (doc_id, text). The plain rule, one document after the other."""
    out, rows = [], [(d, t or "") for d, t in rows]
    for i, (d, t) in enumerate(rows):
        after = rows[(i + 1) % len(rows)][1]
        half = len(t) // 2
        new = t[:len(t) - half] + after[:half]
        a, b, c = (fingerprints.vectors([x.encode()]) for x in (t, new, after))
        out.append((d, len(t), hashlib.sha256(new.encode()).hexdigest(), fingerprints.to_text(a)[0], fingerprints.to_text(b)[0],
                    float(fingerprints.likeness(a, b)[0]), float(fingerprints.likeness(a, c)[0])))
    return out


@pytest.mark.parametrize("buckets", [1, 7])
def test_edited_prints(documents, buckets):
    rows = sorted(((r.doc_id, r.text) for r in documents.collect()), key=lambda r: -r[0])
    got = sorted(map(tuple, fingerprints.edited(documents, buckets).collect()), key=lambda r: -r[0])
    for a, b in zip(got, expected_prints(rows), strict=True):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:])
    assert np.mean([r[5] for r in got]) > 0.35 > 0.1 > np.median([r[6] for r in got])


def test_edited_odd_rows(spark, odd, odd_rows, no_docs):
    got = fingerprints.edited(odd, 5).collect()
    with_id = [r for r in odd_rows if r[0] is not None]
    rows = sorted(((r[0], r[1]) for r in with_id), key=lambda r: -r[0]) + [(None, "no id at all")]  # both rows of id 7 are the same text
    key = lambda r: (r[0] is None, -(r[0] or 0), r[2])
    assert [tuple(r)[:5] for r in sorted(got, key=key)] == [r[:5] for r in sorted(expected_prints(rows), key=key)]
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    assert fingerprints.edited(no_docs).collect() == []
    one = fingerprints.edited(odd.filter("doc_id = 19"), 3).collect()
    assert len(one) == 1 and one[0].near_next == 1.0


def test_one_id_in_many_rows_fills_many_buckets(spark):
    docs = spark.range(3000).select(F.lit(5).cast("bigint").alias("doc_id"), F.lit("the same text\nagain").alias("text"))
    docs = docs.unionByName(spark.createDataFrame([(9, "last"), (1, "first\nof all")], "doc_id long, text string"))
    rows = [(9, "last")] + [(5, "the same text\nagain")] * 3000 + [(1, "first\nof all")]
    got = fingerprints.edited(docs, 6)
    assert sorted(tuple(r)[:5] for r in got.collect()) == sorted(r[:5] for r in expected_prints(rows))
    sizes = got.select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    assert len(sizes) >= 5 and max(r["count"] for r in sizes) < 1500


def test_print_is_a_multiset_of_paragraphs(spark):
    v = lambda t: fingerprints.to_text(fingerprints.vectors([t.encode()]))[0]
    a, b, c = "one two three four", "five six seven", "a b"
    assert v(f"{a}\n{b}\n{c}") == v(f"{c}\n{a}\n{b}") != v(f"{c}\n{a}\n{b}\n{b}")
    assert len({v(""), v("\n"), v("x"), v("X"), v("x\n"), v(" x")}) == 6
    table = spark.createDataFrame([(v(f"{a}\n{b}"), b, f"{c}\n{c}"), (v(a), None, b), (v(f"{c}\n{a}"), a, None)], "p string, out string, come string")
    got = [r.p for r in table.select(fingerprints.update(F.col("p"), F.col("out"), F.col("come")).alias("p")).collect()]
    assert got == [v(f"{a}\n{c}\n{c}"), v(f"{a}\n{b}"), v(c)]
    many = fingerprints.vectors([b"\n".join([b"x y z"] * 5000)])
    assert fingerprints.to_text(fingerprints.put(many, many)) == [v("\n".join(["x y z"] * 10_000))]
    back = fingerprints.from_text([v(a), v(b)])
    assert fingerprints.to_text(back) == [v(a), v(b)]


def test_prints_of_odd_rows(odd, odd_rows, no_docs):
    got = {(r.doc_id, r.fingerprint) for r in fingerprints.fingerprint(odd).collect()}
    assert got == {(r[0], fingerprints.to_text(fingerprints.vectors([(r[1] or "").encode()]))[0]) for r in odd_rows}
    assert fingerprints.fingerprint(no_docs).collect() == []


# --- operator 13

def expected_negatives(rows, every=50):
    rows = sorted(rows)
    whole = [(i, label, np.floor(256 * np.array(v, np.float64)).astype(np.int64)) for i, label, v in rows]
    out = []
    for i, label, v in whole:
        if i % every:
            continue
        scored = sorted(((-int(v[:len(x)] @ x[:len(v)]), j, other == label) for j, other, x in whole if j != i))
        for p, j, _ in [s for s in scored if s[2]][:5]:
            fit = [(s, k) for s, k, same in scored if not same and -50 * p <= -100 * s <= -95 * p][:3]
            out += [(i, j, n + 1, k, -p, -s) for n, (s, k) in enumerate(fit)]
    return sorted(out)


@pytest.mark.parametrize("blocks", [None, 7])
def test_hard_negatives(spark, monkeypatch, blocks):
    if blocks:  # many small blocks, several portions of anchors
        for name in ("ROWS", "ANCHORS", "PORTION"):
            monkeypatch.setattr(hard_negatives, name, blocks)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(4, 20))
    rows = [(int(i), int(i % 4), (centres[i % 4] * rng.uniform(0, 1) + rng.normal(size=20)).astype(np.float32).tolist()) for i in range(300)]
    rows += [(300 + k, k % 3, rows[k][2]) for k in range(40)]  # ties
    rows += [(400, 2, [0.0] * 20), (450, 1, rows[1][2][:5]), (451, 77, rows[2][2])]  # nothing to gain, a short vector, a label of its own
    table = rows + [(500, None, rows[0][2]), (550, 1, None), (600, 1, [float("nan")] * 20), (650, 1, [float("inf")] + [0.0] * 19),
                    (700, 1, [None] + [0.0] * 19), (None, 1, rows[0][2]), rows[10], rows[10]]
    df = spark.createDataFrame([(*r, "clash", "clash") for r in table], "vec_id long, label int, embedding array<float>, score string, g string")
    got = hard_negatives.mine(hard_negatives.prepare(df), anchor_every=25)
    assert sorted(map(tuple, got.collect())) == expected_negatives(rows, 25) != []
    assert hard_negatives.mine(hard_negatives.prepare(df.limit(0))).collect() == []


@pytest.mark.parametrize("seed", range(6))
def test_threshold_join_finds_every_pair(seed):
    rng = np.random.default_rng(seed)
    scale = np.where(rng.uniform(size=50) < 0.3, 40, 3)
    q, x = (np.floor(rng.normal(size=(n, 50)) * scale) for n in (30, 400))
    x[:100] /= 8
    x = np.floor(x)
    exact = q @ x.T
    for t in (np.full(30, -np.inf), np.full(30, 5000.0), rng.uniform(-3000, 20_000, 30), np.full(30, 1e9)):
        a, r, score = hard_negatives.scores_from(q, x, t)
        assert set(zip(a.tolist(), r.tolist())) == set(zip(*(i.tolist() for i in np.nonzero(exact >= t[:, None]))))
        assert (score == exact[a, r]).all()


def test_queries_of_this_file_are_registered():
    assert {"op11_periodic_runs", "op12_fingerprints", "op13_hard_negatives"} <= set(queries.queries())
