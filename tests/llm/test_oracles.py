"""Queries of the subpackage against their DuckDB oracles, on the given tables and on odd rows."""

import pyarrow.parquet as pq
import pytest

from feedlake.llm import decontaminate, exact_dedup, queries, sharding, similar
from oracle_check import duck, rows_of


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_oracle(spark, sf, name):
    df = queries.queries()[name](spark, sf)
    res = duck(sf).execute(queries.oracle_sql()[name])
    got, want = rows_of(df.columns, map(tuple, df.collect())), rows_of([d[0] for d in res.description], res.fetchall())
    assert sorted(df.columns) == sorted(d[0] for d in res.description)
    assert got == want


@pytest.fixture(scope="module")
def odd_duck(odd, tmp_path_factory, sf):
    """Odd rows as DuckDB views; without the null id and the repeated row, which SQL by doc_id cannot tell apart."""
    import duckdb

    at = tmp_path_factory.mktemp("odd")
    table = odd.filter("doc_id is not null and label = 'clash'").toArrow()
    pq.write_table(table, at / "documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{at}/documents.parquet')")
    con.execute("""CREATE TABLE benchmark AS SELECT * FROM (VALUES (1, 'one'), (2, NULL), (3, ''), (4, 'One two'), (5, 'one'))
                   t(item_id, text)""")
    con.execute("INSERT INTO benchmark SELECT 100 + doc_id, text FROM documents WHERE doc_id IN (7, 14)")
    return con


@pytest.mark.parametrize("name,run,sql", [
    ("dedup", exact_dedup.dedup, exact_dedup.ORACLE),
    ("join", similar.join, similar.ORACLE),
    ("shard", sharding.shard_documents, sharding.oracle()),
])
def test_odd_rows(odd, odd_duck, name, run, sql):
    df = run(odd.filter("doc_id is not null and label = 'clash'"))
    res = odd_duck.execute(sql)
    assert rows_of(df.columns, map(tuple, df.collect())) == rows_of([d[0] for d in res.description], res.fetchall())


def test_odd_benchmark(spark, odd, odd_duck):
    """Items of one, two and many words, null and empty items, repeated items."""
    items = spark.createDataFrame(odd_duck.execute("SELECT * FROM benchmark").fetchall(), "item_id long, text string")
    df = decontaminate.find(odd.filter("doc_id is not null and label = 'clash'"), items)
    res = odd_duck.execute(decontaminate.ORACLE)
    got = rows_of(df.columns, map(tuple, df.collect()))
    assert got == rows_of([d[0] for d in res.description], res.fetchall())
    assert sum(r[df.columns.index("contaminated")] for r in map(tuple, df.collect())) >= 5


@pytest.mark.parametrize("lengths", [range(1, 12), (6, 25), (6, 10, 11), (1, 6, 9)])
def test_items_of_every_length(spark, lengths):
    """Short items beside long ones: each length keeps all its hits, also the one that equals the gram length."""
    import duckdb

    def words(tag, n):
        return " ".join(f"{tag}w{j}" for j in range(n))

    items = [(100 * n + i, words(f"i{n}x{i}", n)) for n in lengths for i in range(12)]
    docs = [(i, f"{words(f'a{i}', i % 7)} {t} {words(f'b{i}', 30)}") for i, (_, t) in enumerate(items)]
    docs += [(1000 + i, f"{words('c', 20)} {t.rsplit(' ', 1)[0]} {words('d', 20)} {t}") for i, (_, t) in enumerate(items)]
    docs += [(5000, words("e", 40)), (5001, "")]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", docs)
    con.execute("CREATE TABLE benchmark (item_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO benchmark VALUES (?, ?)", items)
    table, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    df, res = decontaminate.find(table, bench), con.execute(decontaminate.ORACLE)
    got = rows_of(df.columns, map(tuple, df.collect()))
    assert got == rows_of([d[0] for d in res.description], res.fetchall())
    assert sorted(r.doc_id for r in decontaminate.remove(table, bench).collect()) == [5000, 5001]


def test_null_ids_and_repeated_rows(odd, odd_rows):
    n = len(odd_rows)
    for df in (exact_dedup.dedup(odd), similar.join(odd), sharding.shard_documents(odd)):
        rows = df.collect()
        assert len(rows) == n and sum(r.doc_id is None for r in rows) == 1 and sum(r.doc_id == 7 for r in rows) == 2
    kept = similar.keep_one(odd)
    assert kept.columns == odd.columns and kept.filter("doc_id is null").count() == 1


def test_empty_tables(spark, no_docs):
    items = spark.createDataFrame([], "item_id long, text string")
    for df in (exact_dedup.dedup(no_docs), similar.join(no_docs), sharding.shard_documents(no_docs),
               decontaminate.find(no_docs, items)):
        assert df.collect() == []


def test_no_benchmark(spark, odd, odd_rows):
    items = spark.createDataFrame([(1, None), (2, "...")], "item_id long, text string")
    rows = decontaminate.find(odd, items).collect()
    assert len(rows) == len(odd_rows) and not any(r.contaminated or r.n_items or r.n_hit for r in rows)
    assert decontaminate.remove(odd, items).count() == len(odd_rows)
