"""Landed vendor payloads to typed bronze rows, in one pass that also lists what it cannot use.

Each landed frame has a ``payload`` column with one JSON document, as a text or JSON file source
delivers it. ``parsed`` reads a document once, as a variant, and gives a row per element with the
typed values and a list of what is wrong with it. The parsers take the rows from it and
``payload_rejects`` the rest; ``load`` stores one pass and gives both. Nothing is inferred, and no
document, element or date can fail a load. ``loaded_at`` defaults to the load time and can be
fixed for repeatable runs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom import constants as C
from barloom import schemas as S
from barloom.operators.dedupe import first_per_key
from barloom.session import written


def _stamp(loaded_at) -> Column:
    return (F.current_timestamp() if loaded_at is None
            else F.lit(loaded_at).cast("timestamp")).alias("_ingested_at")


def read_payloads(spark: SparkSession, path: str, *keys: str) -> DataFrame:
    """JSON-lines landing files with the given key fields and a ``payload`` string."""
    schema = ", ".join(f"{name} string" for name in (*keys, "payload"))
    return spark.read.schema(schema).json(path)


def number(text: Column, kind: str) -> Column:
    """A number however it is spelled; whole numbers may come with a fraction of zero."""
    if kind == "double":
        return text.try_cast("double")
    value = text.try_cast("double")
    whole = F.when(value == F.floor(value), text.try_cast("decimal(38,6)").try_cast(kind))
    return F.coalesce(text.try_cast(kind), whole)


def iso_date(text: Column) -> Column:
    """The date that a text begins with, as in 2020-01-31 or 2020-01-31T00:00:00Z; else null."""
    begin = F.substring(text, 1, 10)
    return F.when(begin.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), F.try_to_date(begin, "yyyy-MM-dd"))


@dataclass(frozen=True)
class Field:
    """A field of an element: its name there, the column it becomes, and that column's type. A
    ``key`` must have a value. A ``missing`` text stands for no value."""

    name: str
    column: str
    type: T.DataType
    key: bool = False
    missing: str = ""

    def text(self, item: Column) -> Column:
        return F.try_variant_get(item, f"$.{self.name}", "string")

    def held(self, item: Column) -> Column:
        """Whether there is a value at all: present, not null, not blank or marked as missing."""
        value = F.try_variant_get(item, f"$.{self.name}", "variant")
        return F.coalesce(value.isNotNull() & ~F.is_variant_null(value)
                          & F.coalesce(self.text(item) != self.missing, F.lit(True)), F.lit(False))

    def typed(self, text: Column) -> Column:
        if isinstance(self.type, T.NumericType):
            return number(text, self.type.simpleString())
        if isinstance(self.type, T.DateType):
            return iso_date(text)
        if isinstance(self.type, T.TimestampType):
            return F.try_to_timestamp(text)
        return text

    def value(self, item: Column) -> Column:
        if isinstance(self.type, T.ArrayType):
            return F.try_variant_get(item, f"$.{self.name}", "array<string>")
        return F.when(self.held(item), self.typed(self.text(item)))

    @property
    def what(self) -> str:
        kinds = {T.ArrayType: "list", T.DateType: "date", T.TimestampType: "date", T.StringType: "text"}
        return kinds.get(type(self.type), "number")

    def problem(self, held: Column, value: Column, raw: Column) -> Column:
        """(reason, field, raw) of a value that cannot be read or a key that is not there, or null."""
        reason = F.when(held & value.isNull(), F.lit(f"bad {self.what}"))
        if self.key:
            reason = reason.when(~held, F.lit(f"no {self.what}"))
        return F.when(reason.isNotNull(), F.struct(
            reason.alias("reason"), F.lit(self.name).alias("field"), raw.alias("raw")))

    def wrong(self, item: Column) -> Column:
        raw = F.coalesce(self.text(item), F.to_json(F.try_variant_get(item, f"$.{self.name}", "variant")))
        return self.problem(self.held(item), self.value(item), raw)


def _camel(column: str) -> str:
    first, *rest = column.split("_")
    return first + "".join(map(str.title, rest))


def _fields(schema: T.StructType, keys: tuple[str, ...], names: dict[str, str], leave: tuple[str, ...] = ()) -> tuple[Field, ...]:
    return tuple(Field(names.get(f.name, _camel(f.name)), f.name, f.dataType, f.name in keys)
                 for f in schema.fields if f.name not in ("_ingested_at", *leave))


_TRADE = S.PAYLOAD_TRADES["data"].dataType.elementType
#: Where each kind of document holds its elements, and their fields.
KINDS: dict[str, tuple[str | None, tuple[Field, ...]]] = {
    "macro": ("$.observations", (Field("date", "obs_date", T.DateType(), key=True),
                                 Field("value", "value", T.DoubleType(), missing=C.MISSING_MARKER))),
    "bars": ("$", _fields(S.BARS, ("obs_date",), {"obs_date": "date"}, ("symbol",))),
    "news": ("$", _fields(S.NEWS, ("article_id",), {"article_id": "id"})),
    "ticker": (None, _fields(S.TICKERS, ("symbol",), {"symbol": "ticker"}, ("asset_type",))),
    "trades": ("$.data", tuple(Field(f.name, f.name, f.dataType) for f in _TRADE.fields)),
}
_PROBLEMS = "array<struct<reason:string,field:string,raw:string>>"


def _problem(reason: str, raw: Column) -> Column:
    return F.struct(F.lit(reason).alias("reason"), F.lit(None).cast("string").alias("field"), raw.alias("raw"))


def parsed(landed: DataFrame, kind: str, *keys: str, column: str = "payload") -> DataFrame:
    """(keys, row, problems) for each element of each document; batch or streaming input.

    row has the kind's columns and is null where an element gives no row; problems is a list of
    (reason, field, raw). A document that is no JSON ("unreadable") or lacks the kind's list ("other
    shape"; a trade envelope: its type, or the list of a trade message) is one element without a
    row, and so is an element that is no object ("other element"). A key field without a value ("no
    date") or with an unreadable one ("bad date") costs the row; another unreadable field is null in
    it. Fields that are absent, null or blank are null without a problem.
    """
    path, fields = KINDS[kind]
    doc, text = F.col("__doc"), F.col("__text")
    read = landed.select(*keys, F.col(column).alias("__text"), F.try_parse_json(column).alias("__doc"))
    listed = (F.when(F.schema_of_variant(doc).startswith("OBJECT"), F.array(doc)) if path is None
              else F.try_variant_get(doc, path, "array<variant>"))
    shaped = listed
    if kind == "trades":
        named = F.try_variant_get(doc, "$.type", "string")
        # A message of another type has no trades.
        shaped = F.when(named == "trade", listed).when(named.isNotNull(), F.array().cast("array<variant>"))
    whole = F.when(doc.isNull(), _problem("unreadable", text)).when(shaped.isNull(), _problem("other shape", text))
    none = F.lit(None).cast("variant")
    items = F.when(whole.isNotNull(), F.array(none)).otherwise(shaped)
    each = read.select(*keys, whole.alias("__whole"), F.explode(items).alias("__item"))
    item = F.col("__item")
    is_object = F.coalesce(F.schema_of_variant(item).startswith("OBJECT"), F.lit(False))
    told = each.select(*keys, "__whole", is_object.alias("__object"), F.to_json(item).alias("__raw"),
                       F.struct(*(f.value(item).alias(f.column) for f in fields)).alias("row"),
                       F.array_compact(F.array(*(f.wrong(item) for f in fields))).alias("__wrong"))
    complete = F.lit(True)
    for f in fields:
        if f.key:
            complete &= F.col(f"row.{f.column}").isNotNull()
    other = _problem("other element", F.coalesce("__raw", F.lit("null")))
    problems = F.when(F.col("__whole").isNotNull(), F.array("__whole")).when(
        ~F.col("__object"), F.array(other)).otherwise(F.col("__wrong"))
    return told.select(*keys, F.when(F.col("__object") & complete, F.col("row")).alias("row"),
                       problems.cast(_PROBLEMS).alias("problems"))


def rejects(found: DataFrame, key: str | None = None) -> DataFrame:
    """(key, reason, field, raw) of the problems in a frame of ``parsed``."""
    name = F.lit(None).cast("string") if key is None else F.col(key).cast("string")
    return found.select(name.alias("key"), F.inline("problems"))


def payload_rejects(landed: DataFrame, kind: str, key: str | None = None, column: str = "payload") -> DataFrame:
    """(key, reason, field, raw) of all that the parser of this kind cannot use. What it makes no
    row of, or leaves empty though there was a value, has a row here."""
    return rejects(parsed(landed, kind, *([key] if key else []), column=column), key)


def load(landed: DataFrame, kind: str, key: str | None = None, loaded_at=None, **more) -> tuple[DataFrame, DataFrame]:
    """The bronze rows and the rejects of landed documents from one pass over them, which is
    stored in between."""
    found = written(parsed(landed, kind, *([key] if key else [])), f"parsed_{kind}")
    return _ROWS[kind](found, loaded_at=loaded_at, **more), rejects(found, key)


def _macro_rows(found: DataFrame, loaded_at=None) -> DataFrame:
    # Without a value and without a problem: the vendor has none for the day.
    empty = F.col("row.value").isNull() & (F.size("problems") == 0)
    return found.where(F.col("row").isNotNull() & ~empty).select("series_id", "row.*", _stamp(loaded_at))


def _bar_rows(found: DataFrame, loaded_at=None) -> DataFrame:
    return found.where("row is not null").select("symbol", "row.*", _stamp(loaded_at))


def _ticker_rows(found: DataFrame, asset_types: DataFrame, loaded_at=None) -> DataFrame:
    rows = found.where("row is not null").join(asset_types, "symbol").select("asset_type", "row")
    columns = [f.name for f in S.TICKERS.fields if f.name != "_ingested_at"]
    return rows.select("asset_type", "row.*").select(*columns, _stamp(loaded_at))


def _news_rows(found: DataFrame, loaded_at=None) -> DataFrame:
    empty = F.array().cast("array<string>")
    articles = found.where("row is not null").select("row.*").withColumns(
        {"tickers": F.coalesce("tickers", empty), "tags": F.coalesce("tags", empty)}).select("*", _stamp(loaded_at))
    # Copies that differ are settled by their values, newest first.
    order = ["crawl_date", "published_date", "title", "description", "url", "source", "tickers", "tags"]
    return first_per_key(articles, ["article_id"], [F.desc(c) for c in order])


_ROWS = {"macro": _macro_rows, "bars": _bar_rows, "ticker": _ticker_rows, "news": _news_rows}


def parse_macro(landed: DataFrame, loaded_at=None) -> DataFrame:
    """(series_id, payload) -> one row per observation, without missing markers."""
    return _macro_rows(parsed(landed, "macro", "series_id"), loaded_at)


def parse_bars(landed: DataFrame, loaded_at=None) -> DataFrame:
    """(symbol, payload) -> daily bars."""
    return _bar_rows(parsed(landed, "bars", "symbol"), loaded_at)


def parse_tickers(landed: DataFrame, asset_types: DataFrame, loaded_at=None) -> DataFrame:
    """(symbol, payload) plus the configured (symbol, asset_type) -> symbol metadata."""
    return _ticker_rows(parsed(landed, "ticker", "symbol"), asset_types, loaded_at)


def parse_news(landed: DataFrame, loaded_at=None) -> DataFrame:
    """(payload) holding article arrays -> one row per article id."""
    return _news_rows(parsed(landed, "news"), loaded_at)


def read_universe(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(S.CSV_UNIVERSE).csv(path, header=True)


_LISTED = tuple(Field(f.name, c, t) for f, c, t in zip(
    S.CSV_UNIVERSE.fields, [f.name for f in S.UNIVERSE.fields], [f.dataType for f in S.UNIVERSE.fields]))


def parsed_universe(rows: DataFrame) -> DataFrame:
    """(row, problems) for each line of a listing file; empty text is null, an unreadable date too,
    with a problem."""
    blank = lambda f: F.nullif(F.col(f.name), F.lit(""))
    wrong = [f.problem(blank(f).isNotNull(), f.typed(blank(f)), F.col(f.name)) for f in _LISTED]
    return rows.select(F.struct(*(f.typed(blank(f)).alias(f.column) for f in _LISTED)).alias("row"),
                       F.array_compact(F.array(*wrong)).alias("problems"), F.col("ticker").alias("key"))


def parse_universe(rows: DataFrame, loaded_at=None) -> DataFrame:
    """Listing file rows -> universe rows."""
    return parsed_universe(rows).select("row.*", _stamp(loaded_at))


def universe_rejects(rows: DataFrame) -> DataFrame:
    """(key, reason, field, raw) of the dates that ``parse_universe`` cannot read."""
    return rejects(parsed_universe(rows), "key")


def read_seed(spark: SparkSession, path: str, schema=S.SEED_INDICATOR) -> DataFrame:
    """Reference CSV with quoted fields; doubled quotes stand for one quote."""
    return spark.read.schema(schema).csv(path, header=True, quote='"', escape='"')
