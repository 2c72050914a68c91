"""Lines of documents: exploding, numbering, stanzas, titles and speakers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.functions import text as T


def body_lines(poems: DataFrame, key: str = "poem_no") -> DataFrame:
    """(key, pos, line_id, stanza_id, text, notes), one row per line; null lines and bodies give none."""
    rows = poems.select(F.col(key), F.posexplode("body").alias("pos", "line")).where("line IS NOT NULL")
    return rows.select(key, "pos", F.col("line.id").alias("line_id"), F.col("line.stanza_id").alias("stanza_id"), F.col("line.text").alias("text"), F.col("line.marginal_notes").alias("notes"))


def text_lines(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, pos, text) of a text's lines; \\r\\n, \\r and \\n end lines. A null text has none."""
    return docs.select(F.col(key), F.posexplode(F.split(text, r"\r\n|\r|\n")).alias("pos", "text"))


def compared_lines(lines: DataFrame, least: int = 3) -> DataFrame:
    """Adds norm, the form in which lines are compared, and leaves out lines shorter than least in it."""
    return lines.withColumn("norm", T.normalise(F.col("text"))).where(F.length("norm") >= least)


def number_lines(lines: DataFrame, key: str, order: str = "pos") -> DataFrame:
    """Adds line_id, 0 to n-1 within each key."""
    return lines.withColumn("line_id", F.row_number().over(Window.partitionBy(key).orderBy(order)) - 1)


def number_stanzas(rows: DataFrame, key: str, is_marker: Column, order: str = "pos") -> DataFrame:
    """Rows that aren't markers, with stanza_id: contiguous from 0, a marker beginning the next.

    Rows before any marker are a stanza of their own; a marker with no row behind it leaves no gap.
    """
    before = Window.partitionBy(key).orderBy(order)
    raw = rows.withColumn("raw", F.sum(is_marker.cast("int")).over(before)).where(~is_marker)
    return raw.withColumn("stanza_id", F.dense_rank().over(Window.partitionBy(key).orderBy("raw")) - 1).drop("raw")


def first_text(lines: DataFrame, key: str, order: str = "pos") -> DataFrame:
    """(key, title): the first text of each key that isn't empty, null if all are."""
    filled = F.when(F.coalesce(F.col("text"), F.lit("")) != "", F.struct(order, "text"))
    return lines.groupBy(key).agg(F.min(filled)["text"].alias("title"))


def last_valid_before(value: Column, key: str, order: str, start: int = -1) -> Column:
    """The last value that isn't null in the rows before, start where there is none."""
    before = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.last(value, ignorenulls=True).over(before), F.lit(start))


def speakers_to_stanzas(events: DataFrame, key: str, order: str = "pos") -> DataFrame:
    """(key, pos, stanza_id, text, marginal_notes) of drama lines from events (key, pos, kind, text).

    Of the speakers between two stanza wrappers the first one speaks in the stanza that follows; those before the
    first wrapper in stanza 0, those behind the last one nowhere. A stanza's speaker is noted on its first line.
    """
    before = Window.partitionBy(key).orderBy(order)
    named = events.withColumn("text", F.when(F.col("kind") == "speaker", T.speaker(F.col("text"))).otherwise(F.col("text"))).where("kind = 'stanza' OR coalesce(text, '') <> ''")
    counted = named.withColumn("wraps", F.sum((F.col("kind") == "stanza").cast("int")).over(before))
    # a speaker in the gap behind wrapper n belongs to the next stanza, whose number from 0 is n
    first = counted.where("kind = 'speaker'").groupBy(key, F.col("wraps").alias("stanza_id")).agg(F.min_by("text", order).alias("speaker"))
    lines = counted.where("kind = 'line'").withColumn("stanza_id", F.greatest(F.col("wraps") - 1, F.lit(0)))
    opens = F.row_number().over(Window.partitionBy(key, "stanza_id").orderBy(order)) == 1
    noted = lines.withColumn("opens", opens).join(first, [key, "stanza_id"], "left")
    notes = F.when(F.col("opens") & F.col("speaker").isNotNull(), F.array(T.speaker_note(F.col("speaker")))).otherwise(F.expr("cast(array() as array<string>)"))
    return noted.select(key, order, "stanza_id", "text", notes.alias("marginal_notes"))


def to_body(lines: DataFrame, key: str, order: str = "line_id") -> DataFrame:
    """(key, body): the lines of each key as an ordered array of structs."""
    line = F.struct(F.col(order), F.struct(F.col("line_id").alias("id"), "stanza_id", "text", F.lit(False).alias("part"), "marginal_notes").alias("line"))
    return lines.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(line)), lambda x: x["line"]).alias("body"))
