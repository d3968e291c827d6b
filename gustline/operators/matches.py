"""Match documents: unpack, route by status, restrict by date, count."""

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from gustline.functions.times import ingested_at
from gustline.operators.readings import CORRUPT, NOT_JSON, PARSED, WRONG_TYPE, is_object
from gustline.schemas import MATCH_PAYLOAD

# Topics, the final status, and days before and after the day of a poll.
LIVE_TOPIC, HISTORY_TOPIC = "football_live", "football_history"
FINISHED = "FINISHED"
LIVE_DAYS = (0, 1)
HISTORY_DAYS = (30, 0)


def parse_polls(
    raw: DataFrame, value: str = "value", fields: tuple[str, ...] | None = None, with_texts: bool = False
) -> DataFrame:
    """Every element of every poll with all columns of its poll: `position`, the `match` it makes, and the `reason` why it makes none.

    A poll whose elements all fit the layout is parsed once. Any other is taken apart, so that its good elements
    stay: one that is no object or has a field of a wrong type is rejected with its `text`. A poll that is no JSON object, is cut off, or
    has something other than a list of matches, is rejected as a whole, at position -1. A poll without matches has no
    elements. With `fields` the parser skips all others, whatever their types. With `with_texts` all polls are taken apart
    and every element has its text.
    """
    layout = StructType([f for f in MATCH_PAYLOAD if fields is None or f.name in fields])
    corrupt, keep_bad = StructField(CORRUPT, StringType()), {"columnNameOfCorruptRecord": CORRUPT}
    text, no_text = F.col(value).cast("string"), F.lit(None).cast("string")
    read, apart = F.col(PARSED), F.col("_apart")

    def parsed(text: Column, *more: StructField) -> Column:
        return F.from_json(text, StructType([*more, corrupt]), keep_bad)

    def fits(one: Column) -> Column:
        return one.isNotNull() & one[CORRUPT].isNull()

    def rejected(text: Column) -> Column:
        return F.when(is_object(text), WRONG_TYPE).otherwise(NOT_JSON)

    def element(text: Column, made: Column, reason: Column) -> Column:
        return F.struct(text.alias("text"), made.alias("match"), reason.alias("reason"))

    def judged(one: Column) -> Column:
        bad, found = ~fits(one["j"]), one["t"] if with_texts else F.when(~fits(one["j"]), one["t"])
        made = F.struct(*[one["j"][name].alias(name) for name in layout.fieldNames()])
        return element(found, F.when(~bad, made), F.when(bad, rejected(one["t"])))

    # What a generator makes is not parsed again for the columns above it; polls that fit as a whole are not taken apart.
    whole = F.lit(None).cast(StructType([StructField("matches", ArrayType(layout)), corrupt]))
    whole = whole if with_texts else parsed(text, StructField("matches", ArrayType(layout)))
    strings = parsed(text, StructField("matches", ArrayType(StringType())))
    polls = raw.select("*", F.explode(F.array(whole)).alias(PARSED))
    polls = polls.select("*", F.explode(F.array(F.when(~fits(read), strings))).alias("_apart"))
    matches = F.coalesce(read["matches"], F.array().cast(ArrayType(layout)))
    texts = F.coalesce(apart["matches"], F.array().cast("array<string>"))
    good = F.transform(matches, lambda one: element(no_text, one, F.when(one.isNull(), NOT_JSON)))
    mixed = F.transform(F.transform(texts, lambda t: F.struct(t.alias("t"), parsed(t, *layout).alias("j"))), judged)
    broken = F.array(element(text, F.lit(None).cast(layout), rejected(text)))
    listed = polls.select(
        *raw.columns, (fits(read) | fits(apart)).alias("_read"),
        F.posexplode(F.when(fits(read), good).when(fits(apart), mixed).otherwise(broken)).alias("position", "one"),
    )
    return listed.select(*raw.columns, F.when(F.col("_read"), F.col("position")).otherwise(-1).alias("position"), "one.text", "one.match", "one.reason")


def match_rejects(raw: DataFrame, value: str = "value") -> DataFrame:
    """The elements and polls that make no match, with all columns of their poll, and `position`, `text` and `reason`."""
    return parse_polls(raw, value).filter("reason IS NOT NULL").drop("match")


def unpack_matches(
    raw: DataFrame,
    at: Column | None = None,
    value: str = "value",
    fields: tuple[str, ...] | None = None,
) -> DataFrame:
    """One row per match of each poll; a poll without matches gives none, and `match_rejects` returns what makes none.

    With `fields` the parser skips all others.
    """
    made = parse_polls(raw, value, fields).filter("reason IS NULL")
    return made.select("match.*", ingested_at(at).alias("ingested_at"))


def match_texts(raw: DataFrame, value: str = "value") -> DataFrame:
    """The JSON text of each element of the polls that can be read, as it came, for checks of its keys."""
    layout = f"matches ARRAY<STRING>, {CORRUPT} STRING"
    poll = F.from_json(F.col(value).cast("string"), layout, {"columnNameOfCorruptRecord": CORRUPT})
    read = F.filter(F.array(poll), lambda p: p.isNotNull() & p[CORRUPT].isNull())
    polls = raw.select(F.explode(read).alias(PARSED))
    text = polls.select(F.explode(F.coalesce(f"{PARSED}.matches", F.array().cast("array<string>"))).alias("value"))
    return text.withColumn("status", F.get_json_object("value", "$.status"))


def is_finished() -> Column:
    return F.col("status").eqNullSafe(FINISHED)


def route(matches: DataFrame) -> DataFrame:
    """Add the topic: finished matches to the history, all others, also without status, live."""
    return matches.withColumn("topic", F.when(is_finished(), HISTORY_TOPIC).otherwise(LIVE_TOPIC))


def in_days(matches: DataFrame, as_of: date, days: tuple[int, int] = LIVE_DAYS) -> DataFrame:
    """Matches from `days[0]` days before `as_of` to `days[1]` after it, both included.

    ISO dates sort as text, so the bounds stay comparable in the scan.
    """
    first, after = _bounds(as_of, days)
    return matches.filter((F.col("utcDate") >= first) & (F.col("utcDate") < after))


def _bounds(as_of: date, days: tuple[int, int]) -> tuple[str, str]:
    return (as_of - timedelta(days=days[0])).isoformat(), (as_of + timedelta(days=days[1] + 1)).isoformat()


def history(matches: DataFrame, as_of: date, otherwise: Column | None = None) -> DataFrame:
    """Finished matches of the last thirty days, and rows for which `otherwise` holds."""
    first, after = _bounds(as_of, HISTORY_DAYS)
    wanted = (F.col("utcDate") >= first) & (F.col("utcDate") < after) & (F.col("status") == FINISHED)
    return matches.filter(wanted if otherwise is None else wanted | otherwise)


def count_matches(matches: DataFrame) -> DataFrame:
    """Total, live and finished, in one row."""
    return matches.agg(
        F.count("*").alias("total"),
        F.count_if(~is_finished()).alias("live"),
        F.count_if(is_finished()).alias("finished"),
    )
