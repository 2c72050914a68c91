"""Problem 3: text that was decoded with the wrong encoding, and its restoration.

A hidden Markov model labels the characters of a text: one clean state, and one state for each pair of
(encoding written, encoding read), plus one for characters that were lost. A pair's state emits what its
source characters become; a source character that becomes several characters is a chain of substates, walked
here as one unit. A character's clean emission depends on its neighbours: a symbol inside a word is rare, one
that stands alone is not. The most likely path (Viterbi) gives labelled spans, and each span gets the inverse
transform of its state. Runs of ordinary characters, which all states emit alike, are one step of the path.

The states' tables follow from the codecs; the probabilities are fixed parameters below and hold for any size
of input. A text without any character that some state emits is clean without being walked.

Defined results: null and empty texts are clean; lost characters (U+FFFD) are listed and stay as they are; a
span is restored only as far as its units have one source, and only if no other state explains it nearly as well
by another text: such a span stays as it is and is flagged, as is a text with letters that a state hides among the
corpus' own; texts of any length are walked whole.
"""

from __future__ import annotations

import math
import re
import unicodedata
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.plans.shared import spread

#: (written as, read as) of each state; a third member repeats the same mistake.
PAIRS = (
    ("utf-8", "cp1252"), ("utf-8", "cp1252", 2), ("utf-8", "cp1250"), ("utf-8", "iso8859-2"), ("utf-8", "mac_roman"), ("utf-8", "cp850"), ("utf-8", "cp437"),
    ("cp1252", "cp850"), ("cp1252", "cp437"), ("cp850", "cp1252"), ("mac_roman", "cp1252"), ("cp1252", "mac_roman"), ("cp1252", "cp1250"), ("cp1252", "mac_latin2"),
    ("utf-8", "iso8859-15"), ("utf-8", "mac_latin2"), ("utf-8", "cp1251"), ("utf-8", "koi8-r"), ("utf-8", "cp1257"),
)
CYRILLIC = ("cp1251", "koi8-r")
LOST = "�"
ENTER, LEAVE = math.log(1e-5), math.log(0.05)
#: A span is uncertain if another state's log probability comes so near to that of the best one.
MARGIN = math.log(5)
#: Emissions of source characters: the letters of the corpus' languages, then whole classes.
SOURCE = {"ø": 2e-2, "æ": 1e-2, "å": 1e-2, "Ø": 1e-3, "Æ": 1e-3, "Å": 1e-3, "ö": 2e-3, "ä": 5e-4, "ü": 5e-4, "ÿ": 5e-4, "é": 1e-4, "ß": 1e-4, "ñ": 1e-4, "Ö": 1e-4, "Ä": 1e-4, "Ü": 1e-4}
SYMBOL, OTHER_LETTER, QUOTE = 1e-5, 1e-7, 1e-7
ENDS = " .,;:!?/\n"
QUOTES, LETTER_SYMBOLS = "«»", "µªº"
ORDINARY = "æøåÆØÅöäüÖÄÜÿß"


def _read(raw: bytes, codec: str) -> str:
    """Decode; bytes that a code page leaves open become the control character of the same number."""
    return "".join(bytes([b]).decode(codec) if _known(b, codec) else chr(b) for b in raw)


@lru_cache(None)
def _known(b: int, codec: str) -> bool:
    try:
        bytes([b]).decode(codec)
        return True
    except UnicodeDecodeError:
        return False


def _sources() -> list[str]:
    """Characters that texts of the corpus may hold: Latin, combining marks, Greek, Cyrillic, punctuation, full-width forms."""
    spans = ((0xA0, 0x180), (0x1B7, 0x1B8), (0x250, 0x2B0), (0x300, 0x330), (0x370, 0x460), (0x2000, 0x2070), (0x3000, 0x3001), (0xFEFF, 0xFF00), (0xFF01, 0xFF5F))
    return [chr(c) for a, b in spans for c in range(a, b) if unicodedata.category(chr(c)) != "Cn"]


def _image(c: str, pair: tuple) -> str | None:
    try:
        return _read(c.encode(pair[0]), pair[1])
    except UnicodeEncodeError:
        return None


def _table(written: str, read: str, times: int = 1) -> dict[str, str]:
    """What each source character becomes -> the source character; what two sources become the likelier one has."""
    out: dict[str, str] = {}
    # read as Cyrillic, only the likely sources count: letters that look like Latin ones (problem 6) would be others' garbled forms
    for c in SOURCE if read in CYRILLIC else _sources():
        try:
            g = c
            for _ in range(times):
                g = _read(g.encode(written), read)
        except UnicodeEncodeError:
            continue
        if g != c and not g.isascii() and g[0] not in ORDINARY and (g not in out or SOURCE.get(c, 0) > SOURCE.get(out[g], 0)):
            out[g] = c
        if times == 1 and written == "utf-8" and read == "cp1252":
            raw = "".join(map(chr, c.encode(written)))
            out.setdefault(raw, c)
    return out


def beside(text: str, start: int, end: int) -> tuple[str, str]:
    """The characters beside a place, invisible ones left out; spaces at the ends."""
    start -= 1
    while start >= 0 and unicodedata.category(text[start]) == "Cf":
        start -= 1
    while end < len(text) and unicodedata.category(text[end]) == "Cf":
        end += 1
    return text[start] if start >= 0 else " ", text[end] if end < len(text) else " "


class Model:
    def __init__(self) -> None:
        self.tables = [_table(*p) for p in PAIRS]
        #: Per state, letters of the corpus that a likely source character becomes, and which nothing tells from themselves.
        self.hidden = [{g for c in SOURCE if (g := _image(c, p)) and g != c and g in ORDINARY} for p in PAIRS]
        self.longest = max(len(g) for t in self.tables for g in t)
        telltale = {ch for t in self.tables for g, c in t.items() if c in SOURCE for ch in g} | {LOST} | {chr(c) for c in range(0x80, 0xA0)}
        for t in self.tables:  # a many-character unit is told by its first character
            telltale |= {g[0] for g in t if len(g) > 1}
        #: Letters of the corpus tell nothing by themselves.
        self.telltale = {c for c in telltale if not c.isascii() and c not in ORDINARY}
        self.suspect = re.compile("[" + re.escape("".join(sorted(self.telltale))) + "]")
        self.special = re.compile("[^\\x00-\\x7f" + ORDINARY + "]")

    def pattern(self) -> str:
        """A Java pattern that finds the texts which need walking."""
        return "[" + "".join(f"\\x{{{ord(c):x}}}" for c in sorted(self.telltale)) + "]"

    @staticmethod
    def clean(text: str, i: int) -> float:
        c, (left, right) = text[i], beside(text, i, i + 1)
        if c == LOST or 0x80 <= ord(c) < 0xA0:
            return math.log(1e-12)
        if c in QUOTES:
            return math.log(1e-3)
        if c.isalpha() and c not in LETTER_SYMBOLS or unicodedata.combining(c):
            inner = left.islower() or left.isupper() and not right.isupper() and not text[max(i - 2, 0) : i - 1].isupper()
            initial = not left.isalpha() and right.islower()
            if left in ENDS and right in ENDS and not unicodedata.combining(c):  # a word of one letter
                return math.log(1e-10)
            return math.log(1e-10 if c.isupper() and inner else 1e-9 if c.isupper() and initial else 1e-6)
        if unicodedata.category(c) in ("Zs", "Cf"):
            return math.log(1e-3)
        if left.isalpha() or right.isalpha():
            return math.log(1e-9)
        alone = lambda x: x.isspace() or x.isdigit()
        return math.log(1e-4) if alone(left) and alone(right) else math.log(1e-9)

    @staticmethod
    def source(c: str, text: str, i: int, end: int) -> float:
        """Emission of the unit text[i:end] that stands for c."""
        left, right = beside(text, i, end)
        if c in QUOTES:
            return math.log(QUOTE)
        p = SOURCE.get(c, OTHER_LETTER if c.isalpha() else SYMBOL)
        if c.isalpha() and c in SOURCE:
            letters = left.isalpha() or not left.isascii(), right.isalpha() or not right.isascii()
            if c.isupper() and left.islower():
                p *= 1e-4
            elif left.isdigit():
                p *= 1e-5
            elif not any(letters):
                p *= 0.05 if c in "åøÅØ" else 1e-4
        return math.log(p)

    def label(self, text: str) -> list[tuple[int, int, int]]:
        """Spans (start, end, state) of the most likely path that aren't clean; the state of lost characters is the last one."""
        n_states = len(self.tables)
        n = len(text)
        marks = [m.start() for m in self.special.finditer(text)]
        if not marks:
            return []
        units = {m: [(j, s, src) for s, table in enumerate(self.tables, 1) for j in range(m + 1, min(n, m + self.longest) + 1) if (src := table.get(text[m:j])) is not None] for m in marks}
        stops = sorted({0, n, *marks, *(m + 1 for m in marks), *(j for u in units.values() for j, _, _ in u)})
        following = dict(zip(stops, stops[1:]))
        # best[i][s]: log probability of the best path over text[:i] that ends in state s (0 clean, k pair k)
        best: dict[int, list[float]] = {0: [0.0] + [-math.inf] * n_states}
        back: dict[tuple[int, int], tuple[int, int]] = {}
        for i in stops[:-1]:
            if i not in best:
                continue
            now = best[i]
            into = [max((now[0], 0), *((now[s] + LEAVE, s) for s in range(1, n_states + 1)))]
            into += [max((now[s], s), (now[0] + ENTER, 0)) for s in range(1, n_states + 1)]
            if i in units:
                moves = [(i + 1, 0, into[0][0] + self.clean(text, i), into[0][1])]
                moves += [(j, s, into[s][0] + self.source(src, text, i, j), into[s][1]) for j, s, src in units[i]]
            else:
                moves = [(following[i], s, *into[s]) for s in range(n_states + 1)]
            for j, s, value, origin in moves:
                at = best.setdefault(j, [-math.inf] * (n_states + 1))
                if value > at[s]:
                    at[s] = value
                    back[j, s] = (i, origin)
        s = max(range(n_states + 1), key=lambda k: best[n][k])
        spans: list[tuple[int, int, int]] = []
        j = n
        while j > 0:
            i, frm = back[j, s]
            if s:
                if spans and spans[-1][0] == j and spans[-1][2] == s:
                    spans[-1] = (i, spans[-1][1], s)
                else:
                    spans.append((i, j, s))
            j, s = i, frm
        spans = [x for x in spans[::-1] if any(x[0] <= m < x[1] for m in marks)]
        spans += [(m, m + 1, n_states + 1) for m in marks if text[m] == LOST]
        return sorted(spans)

    def reading(self, text: str, start: int, end: int, s: int) -> tuple[float, str] | None:
        """(log probability, source text) of the span by one state, None where the state doesn't have all of its special characters."""
        table = self.tables[s - 1]
        best: dict[int, tuple[float, str]] = {start: (0.0, "")}
        for i in range(start, end):
            if (at := best.get(i)) is None:
                continue
            moves = [(j, self.source(src, text, i, j), src) for j in range(i + 1, min(end, i + self.longest) + 1) if (src := table.get(text[i:j])) is not None]
            if not self.special.match(text[i]):
                moves.append((i + 1, 0.0, text[i]))
            for j, value, src in moves:
                if j not in best or at[0] + value > best[j][0]:
                    best[j] = (at[0] + value, at[1] + src)
        return best.get(end)

    def uncertain(self, text: str, span: tuple[int, int, int]) -> bool:
        """Whether a state other than the span's explains it nearly as well by another text."""
        start, end, s = span
        if s > len(self.tables) or (own := self.reading(text, start, end, s)) is None:
            return s <= len(self.tables)
        others = (self.reading(text, start, end, t) for t in range(1, len(self.tables) + 1) if t != s)
        return any(o is not None and o[1] != own[1] and o[0] > own[0] - MARGIN for o in others)

    def restore(self, text: str, spans: list[tuple[int, int, int]]) -> str:
        out, at = [], 0
        for start, end, s in spans:
            out.append(text[at:start])
            at = end
            if s > len(self.tables):
                out.append(text[start:end])
                continue
            table, i = self.tables[s - 1], start
            while i < end:
                for j in range(min(end, i + self.longest), i, -1):
                    if (src := table.get(text[i:j])) is not None:
                        out.append(src)
                        i = j
                        break
                else:
                    out.append(text[i])
                    i += 1
        return "".join(out) + text[at:]


#: A quick test that all texts with a character of interest pass: anything but ASCII and the corpus' own letters and quotes.
UNUSUAL = "[^\\x00-\\x7f" + ORDINARY + QUOTES[1] + "]"


def units(poems: DataFrame, pattern: str | None = None) -> DataFrame:
    """(poem_no, line_id, text) of the titles (line -1) and lines that hold an unusual character, and pattern if one is given."""
    title = F.struct(F.lit(-1).alias("line_id"), F.col("title").alias("text"))
    lines = F.transform("body", lambda x: F.struct(x["id"].alias("line_id"), x["text"].alias("text")))
    every = F.concat(F.array(title), F.coalesce(lines, F.expr("cast(array() as array<struct<line_id:int,text:string>>)")))
    found = F.filter(every, lambda x: x["text"].rlike(UNUSUAL) & x["text"].rlike(pattern) if pattern else x["text"].rlike(UNUSUAL))
    return spread(poems.select("poem_no", "title", "body")).select("poem_no", F.explode(found).alias("u")).select("poem_no", "u.line_id", "u.text")


def without_garbled(texts: DataFrame) -> DataFrame:
    """The texts (poem_no, line_id, text) in which every character is labelled clean."""

    def run(batches):
        model = Model()
        for batch in batches:
            yield batch.filter(pa.array([not (model.suspect.search(t) and model.label(t)) for t in batch.column(2).to_pylist()], pa.bool_()))

    return texts.mapInArrow(run, texts.schema)


def garbled(texts: DataFrame) -> DataFrame:
    """(poem_no, line_id, text) -> the garbled ones, with the restored text, whether nothing is lost, and the pairs of encodings."""
    names = ["->".join(map(str, p[:2])) + (" twice" if len(p) > 2 else "") for p in PAIRS] + ["lost"]

    def run(batches):
        model = Model()
        for batch in batches:
            rows = []
            for no, line, text in zip(*(batch.column(k).to_pylist() for k in range(3))):
                if spans := model.label(text):
                    doubtful = [model.uncertain(text, x) for x in spans]
                    hidden = any(s <= len(PAIRS) and model.hidden[s - 1].intersection(text) for _, _, s in spans)
                    kinds = sorted({names[s - 1] + (" uncertain" if d else "") for (_, _, s), d in zip(spans, doubtful)})
                    sure = [x for x, d in zip(spans, doubtful) if not d]
                    rows.append((no, line, text, model.restore(text, sure), LOST not in text and not hidden and not any(doubtful), ", ".join(kinds)))
            types = (pa.int64(), pa.int32(), pa.string(), pa.string(), pa.bool_(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], ["poem_no", "line_id", "text", "restored", "whole", "read_as"])

    return texts.mapInArrow(run, "poem_no long, line_id int, text string, restored string, whole boolean, read_as string")


def garbled_poems(poems: DataFrame) -> DataFrame:
    return garbled(units(poems, Model().pattern()))
