"""Data-quality rules of poem documents: each finding is a row.

Documents are read as variants, so that a wrong type, a missing key and a null stay three different things.
Rules on a document are one array expression, rules on its lines come from the exploded body; the rules on
numbering compare with the last valid number before, which a window finds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.plans.shared import spread

# The keys a document must have, the fields of a source that should be there, the parts of a line.
KEYS = ("id", "title", "year_created", "author", "source", "body", "neighbors", "duplicate", "locations")
SOURCE_FIELDS = ("title", "year_published", "place")
LINE_FIELDS = ("id", "stanza_id", "text")
PARTS = ("I", "M", "F")
ERROR, WARNING, INFO = "error", "warning", "info"


def kind(v: Column) -> Column:
    """Type of a variant by name, VOID for a null, null where the key is missing."""
    return F.regexp_extract(F.schema_of_variant(v), "^[A-Z]+", 0)


def get(v: Column, path: str, to: str = "variant") -> Column:
    return F.try_variant_get(v, path, to)


def _finding(when: Column, level: str, rule: str, message: Column | str) -> Column:
    text = F.lit(message) if isinstance(message, str) else message
    return F.when(when, F.struct(F.lit(level).alias("level"), F.lit(rule).alias("rule"), text.alias("message")))


BLANK = r"^[\s\x{a0}]*$"


def parsed(files: DataFrame, path: str = "path", text: str = "text") -> DataFrame:
    """(path, text, doc): doc is null where the text is no JSON."""
    rows = spread(files.select(F.col(path).alias("path"), F.col(text).alias("text")))
    return rows.select("path", "text", F.try_parse_json("text").alias("doc"))


#: Fields of which the rules ask the type, and those of which they ask the value.
DOC_KINDS = ("id", "title", "year_created", "author", "source", "body", "author.name", "author.wiki", "author.born", "author.died", "source.corpus", "source.title", "source.year_published", "source.place", "source.url", "source.printer")
DOC_TEXTS = ("id", "author.name", "author.wiki", "source.corpus", "source.url")
LINE_KINDS = ("id", "stanza_id", "text", "part", "words", "marginal_notes")


def _kinds(v: Column, fields: tuple[str, ...]) -> list[Column]:
    """Types of fields as columns, found once and not in each rule."""
    return [kind(get(v, "$." + f)).alias("k_" + f.replace(".", "_")) for f in fields]


def _k(field: str) -> Column:
    return F.col("k_" + field.replace(".", "_"))


def _text(field: str) -> Column:
    return F.col("t_" + field.replace(".", "_"))


def _is_not(field: str, *kinds: str) -> Column:
    """A value is there and has none of the kinds."""
    return F.coalesce(~_k(field).isin(*kinds), F.lit(False))


def _there(field: str) -> Column:
    return F.coalesce(_k(field) != "VOID", F.lit(False))


def _no_text(field: str) -> Column:
    """A value that isn't a string with something in it."""
    return (_k(field) != "STRING") | F.coalesce(_text(field).rlike(BLANK), F.lit(True))


def _document_rules() -> list[Column]:
    doc = F.col("doc")
    keys = F.col("keys")
    span = F.col("span")
    whole_span = (F.size(span) == 2) & F.forall(span, lambda x: kind(x) == "BIGINT")
    first, last = (get(doc, f"$.year_created[{k}]", "bigint") for k in (0, 1))
    is_list = F.coalesce(_k("year_created") == "ARRAY", F.lit(False))
    in_author, in_source = (F.coalesce(_k(f) == "OBJECT", F.lit(False)) for f in ("author", "source"))
    missing = lambda f: _k(f).isNull()
    extra = F.array_sort(F.array_except(keys, F.array(*map(F.lit, KEYS))))
    return [
        _finding(F.lit(True), INFO, "V34", F.concat(F.lit("validated "), F.col("path"))),
        _finding(F.size(extra) > 0, WARNING, "V03", F.concat(F.lit("unexpected keys: "), F.array_join(extra, ", "))),
        *[_finding(~F.array_contains(keys, k), ERROR, "V04", f"missing key {k}") for k in KEYS],
        _finding(_there("id") & ~((_k("id") == "STRING") & (_text("id") == "")), INFO, "V05", "id is filled"),
        _finding(_is_not("title", "STRING", "VOID"), ERROR, "V06", F.concat(F.lit("title is "), _k("title"))),
        _finding(is_list & ~whole_span, ERROR, "V07", "year_created is no list of two whole numbers"),
        _finding(is_list & whole_span & (first > last), ERROR, "V08", "year_created span is reversed"),
        _finding(_is_not("year_created", "BIGINT", "ARRAY", "VOID"), ERROR, "V09", F.concat(F.lit("year_created is "), _k("year_created"))),
        _finding(_is_not("author", "OBJECT"), ERROR, "V10", "author is no object"),
        _finding(in_author & missing("author.name"), ERROR, "V11", "author.name is missing"),
        _finding(in_author & ~missing("author.name") & _no_text("author.name"), ERROR, "V12", "author.name is no text"),
        *[_finding(in_author & _is_not(f"author.{f}", "BIGINT", "BOOLEAN", "VOID"), ERROR, "V13", f"author.{f} is no whole number") for f in ("born", "died")],
        _finding(in_author & _there("author.wiki") & _no_text("author.wiki"), ERROR, "V14", "author.wiki is no text"),
        _finding(in_author & _there("author.wiki") & ~_no_text("author.wiki") & ~_text("author.wiki").rlike(r"^\p{L}"), WARNING, "V15", "author.wiki doesn't begin with a letter"),
        _finding(_is_not("source", "OBJECT"), ERROR, "V16", "source is no object"),
        _finding(in_source & missing("source.corpus"), ERROR, "V17", "source.corpus is missing"),
        _finding(in_source & ~missing("source.corpus") & _no_text("source.corpus"), ERROR, "V18", "source.corpus is no text"),
        *[_finding(in_source & missing(f"source.{f}"), WARNING, "V19", f"source.{f} is missing") for f in SOURCE_FIELDS],
        _finding(in_source & _is_not("source.year_published", "BIGINT", "BOOLEAN", "VOID"), ERROR, "V20", "source.year_published is no whole number"),
        _finding(in_source & _there("source.url") & ((_k("source.url") != "STRING") | ~_text("source.url").rlike("^https?://")), ERROR, "V21", "source.url is no http address"),
        _finding(in_source & _is_not("source.printer", "STRING", "VOID"), ERROR, "V21", "source.printer is no text"),
        _finding(_is_not("body", "ARRAY"), ERROR, "V22", "body is no list"),
    ]


def _line_rules() -> list[Column]:
    line = F.col("line")
    is_object = F.coalesce(F.col("k_line") == "OBJECT", F.lit(False))
    number = lambda f: _k(f).isin("BIGINT", "DECIMAL", "DOUBLE")
    fits = (
        (_k("part") == "VOID") | (number("part") & (get(line, "$.part", "double") == 0)) | ((_k("part") == "BOOLEAN") & ~get(line, "$.part", "boolean"))
        | ((_k("part") == "STRING") & get(line, "$.part", "string").isin(*PARTS))
    )
    filled = (
        ((_k("words") == "ARRAY") & (F.size(get(line, "$.words", "array<variant>")) > 0)) | ((_k("words") == "STRING") & (get(line, "$.words", "string") != ""))
        | (number("words") & (get(line, "$.words", "double") != 0)) | ((_k("words") == "BOOLEAN") & get(line, "$.words", "boolean"))
        | ((_k("words") == "OBJECT") & (F.schema_of_variant(get(line, "$.words")) != "OBJECT<>"))
    )
    notes = F.col("notes")
    no_text = F.exists(notes, lambda n: F.coalesce(kind(n) != "STRING", F.lit(True)))
    blank = F.exists(notes, lambda n: (kind(n) == "STRING") & n.try_cast("string").rlike(BLANK))
    return [
        _finding(~is_object, ERROR, "V23", "line is no object"),
        *[_finding(is_object & _k(f).isNull(), ERROR, "V24", f"line misses {f}") for f in LINE_FIELDS],
        _finding(is_object & _is_not("id", "BIGINT"), ERROR, "V25", "line id is no whole number"),
        _finding(is_object & F.col("id").isNotNull() & (F.col("id") != F.col("id_before") + 1), WARNING, "V26", F.concat(F.lit("line id "), F.col("id").cast("string"), F.lit(" after "), F.col("id_before").cast("string"))),
        _finding(is_object & _is_not("stanza_id", "BIGINT"), ERROR, "V27", "stanza_id is no whole number"),
        _finding(is_object & (F.col("stanza") < F.col("stanza_before")), WARNING, "V28", "stanza_id decreases"),
        _finding(is_object & _is_not("text", "STRING"), ERROR, "V29", "line text is no text"),
        _finding(is_object & F.coalesce(filled, F.lit(False)), INFO, "V30", "words are filled"),
        _finding(is_object & _k("part").isNotNull() & ~F.coalesce(fits, F.lit(False)), WARNING, "V31", "part is none of false, I, M, F"),
        _finding(is_object & _is_not("marginal_notes", "ARRAY", "VOID"), ERROR, "V32", "marginal_notes is no list"),
        _finding(is_object & no_text, ERROR, "V32", "a marginal note is no text"),
        _finding(is_object & blank, WARNING, "V33", "a marginal note is blank"),
    ]


def findings(files: DataFrame, path: str = "path", text: str = "text") -> DataFrame:
    """(path, pos, level, rule, message); pos is the line's place in the body, null for the document.

    A text that is no JSON (null and empty ones too) has the one finding V01; a document that is no object V02
    besides its banner.
    """
    docs = parsed(files, path, text)
    doc, line = F.col("doc"), F.col("line")
    is_object = F.coalesce(kind(doc) == "OBJECT", F.lit(False))
    texts = [get(doc, "$." + f, "string").alias("t_" + f.replace(".", "_")) for f in DOC_TEXTS]
    # one pass for whatever is said of a document, one for its lines
    asked = docs.select("path", doc.isNotNull().alias("is_json"), is_object.alias("is_object"), "doc", F.json_object_keys("text").alias("keys"), get(doc, "$.year_created", "array<variant>").alias("span"), *_kinds(doc, DOC_KINDS), *texts)
    scalar = F.col("is_json") & ~F.col("is_object")
    rules = [_finding(~F.col("is_json"), ERROR, "V01", "no JSON"), _finding(scalar, INFO, "V34", "validated"), _finding(scalar, ERROR, "V02", "the document is no object"), *[F.when(F.col("is_object"), r) for r in _document_rules()]]
    of_docs = asked.select("path", F.explode(F.filter(F.array(*rules), lambda f: f.isNotNull())).alias("f"))
    objects = docs.where(is_object)
    rows = objects.select("path", F.posexplode(get(doc, "$.body", "array<variant>")).alias("pos", "line"))
    kinds = rows.select("path", "pos", "line", kind(line).alias("k_line"), *_kinds(line, LINE_KINDS))
    number = lambda f: F.when(_k(f) == "BIGINT", get(line, "$." + f, "bigint"))
    notes = F.when(_k("marginal_notes") == "ARRAY", get(line, "$.marginal_notes", "array<variant>"))
    before = Window.partitionBy("path").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    lines = kinds.withColumns({"id": number("id"), "stanza": number("stanza_id"), "notes": notes})
    last = lambda c: F.coalesce(F.last(c, ignorenulls=True).over(before), F.lit(-1))
    lines = lines.withColumn("id_before", last("id")).withColumn("stanza_before", last("stanza"))
    of_lines = lines.select("path", "pos", F.explode(F.filter(F.array(*_line_rules()), lambda f: f.isNotNull())).alias("f")).select("path", "pos", "f.*")
    return of_docs.select("path", F.lit(None).cast("int").alias("pos"), "f.*").unionByName(of_lines)


def by_level(found: DataFrame) -> DataFrame:
    """(path, errors, warnings), and a total with a null path; remarks aren't counted."""
    return found.rollup("path").agg(F.count_if(F.col("level") == ERROR).alias("errors"), F.count_if(F.col("level") == WARNING).alias("warnings"))


def has_errors(found: DataFrame) -> bool:
    return bool(found.agg(F.bool_or(F.col("level") == ERROR)).first()[0])
