"""``rest_records``: paged JSON listings as typed records, with filters sent to the server.

    spark.read.format("rest_records")
        .schema("o_orderkey bigint, o_orderstatus string, season bigint")   # only these columns are read from a record
        .option("url", "/orders").option("transport", json.dumps({...}))
        .option("records", "records")                                     # array key of a page
        .option("paths", json.dumps({"team": "homeTeam.id"}))             # columns whose path is not their name
        .option("params", json.dumps({"season =": "season", "match_date >=": "dateFrom", "match_date <=": "dateTo"}))
        .load().where("season = 1996 and match_date > '1996-03-01' and o_totalprice > 1000")

``params`` says which comparison of which column the server can answer. Spark
hands over the conjuncts of a filter (``pushFilters``):

* a comparison that the server answers becomes a request parameter, in the order of
  ``params``, so fewer pages are asked for. The scan node shows it as a pushed filter. Its records are
  tested again where they are read, because a server may ignore a parameter it does not know;
* ``>`` and ``<`` are sent as the bound's ``>=`` and ``<=`` and stay with Spark;
* everything else stays with Spark: other comparisons, a second value for a parameter that is
  taken, and values that the client does not send (null, empty text, season 0).

Pages are planned and fetched as ``rest_json`` does (the first page, asked once
with the parameters, reports ``total_pages``). A value that is missing or does
not have the column's type is null.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Iterator
from urllib.parse import quote_plus

from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual)

from feedlake.sources.rest_json import RestJsonReader

#: Comparison -> (parameter's operator, is the parameter's answer exact).
OPERATORS = {EqualTo: ("=", True), GreaterThanOrEqual: (">=", True), LessThanOrEqual: ("<=", True),
             GreaterThan: (">=", False), LessThan: ("<=", False)}


def sent_value(value) -> str | None:
    """A parameter's text; None if the client would not send it."""
    if isinstance(value, bool):
        return "true" if value else None
    if isinstance(value, (dt.date, dt.datetime)):
        return value.isoformat()
    return str(value) if isinstance(value, (int, str)) and value else None


def typed(value, kind: T.DataType):
    """The value if it has the column's type, else None."""
    if isinstance(kind, T.StringType):
        return value if isinstance(value, str) else None
    if isinstance(kind, T.BooleanType):
        return value if isinstance(value, bool) else None
    if isinstance(value, bool) or not isinstance(value, (int, float)):
        return None
    if isinstance(kind, T.DoubleType):
        return float(value)
    bits = {T.LongType: 63, T.IntegerType: 31}[type(kind)]
    return value if isinstance(value, int) and -(1 << bits) <= value < 1 << bits else None


class RestRecordsReader(RestJsonReader):
    def __init__(self, options: dict, schema: T.StructType):
        super().__init__(options)
        self.array = options.get("records", "records")
        paths = json.loads(options.get("paths", "{}"))
        self.columns = [(f.name, paths.get(f.name, f.name).split("."), f.dataType) for f in schema.fields]
        for name, _, kind in self.columns:
            if not isinstance(kind, (T.StringType, T.BooleanType, T.DoubleType, T.LongType, T.IntegerType)):
                raise ValueError(f"column {name}: type {kind.simpleString()} is not supported")
        self.server = {tuple(k.rsplit(" ", 1)): v for k, v in json.loads(options.get("params", "{}")).items()}
        self.sent: dict[str, str] = {}
        self.tests: list[tuple[int, str, object]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802 (the API's name)
        names = [c[0] for c in self.columns]
        for f in filters:
            op, exact = OPERATORS.get(type(f), (None, False))
            name = ".".join(getattr(f, "attribute", ()))
            param, text = self.server.get((name, op)), sent_value(getattr(f, "value", None))
            if param is None or text is None or param in self.sent or name not in names:
                yield f
                continue
            self.sent[param] = text
            if exact:
                self.tests.append((names.index(name), op, f.value))
            else:
                yield f
        order = list(self.server.values())
        if self.sent:
            query = "&".join(f"{p}={quote_plus(self.sent[p])}" for p in sorted(self.sent, key=order.index))
            self.url = f"{self.url}{'&' if '?' in self.url else '?'}{query}"

    def _passes(self, row: tuple) -> bool:
        for i, op, value in self.tests:
            x = row[i]
            if x is None or not (x == value if op == "=" else x >= value if op == ">=" else x <= value):
                return False
        return True

    def read(self, partition: InputPartition):
        for page in super().read(partition):
            for record in json.loads(page[-1]).get(self.array) or []:
                row = []
                for _, path, kind in self.columns:
                    value = record
                    for key in path:
                        value = value.get(key) if isinstance(value, dict) else None
                    row.append(typed(value, kind))
                if self._passes(tuple(row)):
                    yield tuple(row)


class RestRecordsDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "rest_records"

    def schema(self) -> str:
        raise ValueError("rest_records needs a schema")

    def reader(self, schema: T.StructType) -> RestRecordsReader:
        return RestRecordsReader(dict(self.options), schema)


def register(spark) -> None:
    """Registers the source and lets Spark hand filters to Python sources (off by default)."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(RestRecordsDataSource)
