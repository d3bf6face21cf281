"""Text functions with the semantics of Python's str, as Spark columns.

Python's whitespace has 29 code points, of which the JVM's \\s knows few; WS spells
them out. `lower`, `length` and `sha2` agree with Python's as they are.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The code points that Python's str.split and str.strip take for whitespace.
WS_RANGES = "\\t-\\r\\x1c-\\x20\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}"
WS = f"[{WS_RANGES}]"
NOT_WS = f"[^{WS_RANGES}]"
WORD = "[\\p{L}\\p{N}_]"
SPACES = "".join(c for c in map(chr, range(0x3001)) if c.isspace())
# For Java's patterns over whole texts: letters fail the first two ranges, so that the others are not tried on them; a single blank is no match.
_WS = f"[\\x00-\\x20\\x{{80}}-\\x{{3000}}&&{WS}]"
_NOT_ONE_BLANK = f"[\\x00-\\x1f\\x{{80}}-\\x{{3000}}&&{WS}]{_WS}*| {_WS}+"
# Watermarks, headings, marks of code, greetings.
WATERMARKS = ("OceanofPDF\\.com", "www\\.allitebooks\\.com", "www\\.it-ebooks\\.info")
HEADINGS = (f"(?iu)^{WS}*Chapter{WS}+\\p{{Nd}}+[:.]?", f"(?iu)^{WS}*Part{WS}+[IVXLCDM]+[:.]?", f"^{WS}*\\p{{Nd}}+\\.{WS}+[A-Z][a-zA-Z{WS_RANGES}]+\\z")
HEADING_CHARS = 120
CODE_LINES = (">>>", "\\.\\.\\.", f"import{WS}+", f"from{WS}+{NOT_WS}+{WS}+import", f"def{WS}+{WORD}+\\(.*\\):", f"class{WS}+{WORD}+[:\\(]", "#")
CODE_SYMBOLS = (" = ", " == ", " += ", "()", "[]", "{}")
GREETINGS = ("Hello!?", "Hi!?", "Certainly!?", "Great question!?", "I'd be happy to help\\.?", "I would be glad to help\\.?", "I'd be glad to explain\\.?", "Let's dive in\\.?", f"Sure,?{WS}*")
STRICT_DIFFICULTY = (("Beginner", ("begin", "easy")), ("Intermediate", ("inter", "med")), ("Advanced", ("adv", "hard", "expert")))


def let(value: Column, body) -> Column:
    """body(value) with value evaluated once, as a lambda's variable, wherever the optimizer moves the expression."""
    return F.element_at(F.transform(F.array(value), body), 1)


def strip(text: Column) -> Column:
    """By trim, which looks at the ends only; a pattern tries every blank of the text, and a long run from each of its places."""
    return F.trim(text, F.lit(SPACES))


def rstrip(text: Column) -> Column:
    return F.regexp_replace(text, f"{WS}+\\z", "")


def normalized(text: Column) -> Column:
    """Lower case, runs of whitespace as one blank, none at the ends."""
    return F.trim(F.regexp_replace(F.lower(text), _NOT_ONE_BLANK, " "))


def text_hash(text: Column) -> Column:
    """SHA-256 of the normalized text, lowercase hex."""
    return F.sha2(normalized(text), 256)


def file_hash(content: Column) -> Column:
    """SHA-256 of a file's bytes, as `binaryFile` reads them."""
    return F.sha2(content, 256)


def signature(text: Column) -> Column:
    """The text without whitespace in lower case; empty for null."""
    return F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), WS, "")


def word_count(text: Column) -> Column:
    return F.size(F.regexp_extract_all(text, F.lit(f"({NOT_WS}+)"), 1))


def approx_tokens(text: Column) -> Column:
    return F.floor(F.length(text) / 4).cast("int")


def chunk_id(number: Column) -> Column:
    return F.format_string("chunk_%03d", number)


def book_name(path: Column) -> Column:
    """A file's stem, underscores and hyphens as blanks."""
    stem = F.regexp_replace(F.regexp_extract(path, "([^/]+)\\z", 1), "(?<=.)\\.[^.]*\\z", "")
    return F.translate(stem, "_-", "  ")


def duration(seconds: Column) -> Column:
    s = F.floor(seconds).cast("long")
    hours, minutes, rest = F.floor(s / 3600).cast("long"), F.floor(s % 3600 / 60).cast("long"), s % 60
    return F.when(hours > 0, F.format_string("%dh %dm %ds", hours, minutes, rest)).when(minutes > 0, F.format_string("%dm %ds", minutes, rest)).otherwise(F.format_string("%ds", rest))


def without_watermarks(text: Column) -> Column:
    for mark in WATERMARKS:
        text = F.regexp_replace(text, f"(?iu){mark}", "")
    return strip(text)


def is_heading(text: Column) -> Column:
    t = strip(text)
    match = t.rlike(HEADINGS[0])
    for pattern in HEADINGS[1:]:
        match = match | t.rlike(pattern)
    return (F.length(t) <= HEADING_CHARS) & match


def nfkc(text: Column) -> Column:
    """Unicode NFKC. Spark has no function for it; ASCII texts, which it leaves alone, are handed on by a guard in the batch."""
    import unicodedata

    @F.pandas_udf("string")
    def run(texts):
        return texts.map(lambda t: t if t is None or t.isascii() else unicodedata.normalize("NFKC", t))

    return run(text)


def dehyphenate(text: Column) -> Column:
    """Words that a hyphen splits at a line's end are joined."""
    return F.regexp_replace(text, f"({WORD}+)-{WS}*\\n{WS}*({WORD}+)", "$1$2")


def code_like(text: Column) -> Column:
    """A backtick, a line that begins like code, or two kinds of symbols in several lines."""
    lines = F.split(text, "\n")
    marker = f"(?d)^{WS}*(?:{'|'.join(CODE_LINES)})"
    symbols = sum((F.when(F.contains(text, F.lit(s)), 1).otherwise(0) for s in CODE_SYMBOLS), F.lit(0))
    return F.contains(text, F.lit("`")) | F.exists(lines, lambda x: x.rlike(marker)) | ((symbols >= 2) & (F.size(lines) > 1))


def clean_code(text: Column) -> Column:
    """Indents stay, blanks inside lines become one, line ends are stripped."""

    def line(x: Column) -> Column:
        indent = F.regexp_extract(x, "^([ \\t]*)", 1)
        return F.concat(indent, F.regexp_replace(rstrip(x.substr(F.length(indent) + 1, F.length(x))), "[ \\t]+", " "))

    return strip(F.array_join(F.transform(F.split(text, "\n"), line), "\n"))


def clean_prose(text: Column) -> Column:
    return strip(F.regexp_replace(F.translate(text, "\n", " "), "[ \\t]+", " "))


def clean_segment(text: Column, unicode: bool = True) -> Column:
    """NFKC (unless told that it changes nothing), hyphens, then the code or the prose branch; empty for null."""
    t = F.coalesce(text, F.lit(""))
    t = dehyphenate(nfkc(t) if unicode else t)
    return let(t, lambda x: F.when(code_like(x), clean_code(x)).otherwise(clean_prose(x)))


def clean_text(text: Column) -> Column:
    """clean_segment() of every paragraph, blank ones dropped. NFKC runs on the whole text: no paragraph break comes or goes by it."""
    t = nfkc(F.coalesce(text, F.lit("")))
    paragraphs = F.filter(F.split(t, "\n\n"), lambda x: F.length(strip(x)) > 0)
    return F.array_join(F.transform(paragraphs, lambda x: clean_segment(x, unicode=False)), "\n\n")


def strip_greetings(text: Column) -> Column:
    """Each opening phrase is taken off once, in order."""
    t = strip(text)
    for phrase in GREETINGS:
        t = strip(F.regexp_replace(t, f"(?iu)^{phrase}", ""))
    return t


def strict_difficulty(text: Column) -> Column:
    """One of the three levels, or null."""
    low, out = F.lower(text), None
    for level, marks in STRICT_DIFFICULTY:
        hit = F.contains(low, F.lit(marks[0]))
        for m in marks[1:]:
            hit = hit | F.contains(low, F.lit(m))
        out = F.when(hit, level) if out is None else out.when(hit, level)
    return out


def lenient_difficulty(text: Column) -> Column:
    """One of the three levels, Intermediate for anything else."""
    low = F.lower(strip(text))
    return F.when(low == "beginner", "Beginner").when(low == "advanced", "Advanced").otherwise("Intermediate")


def fenced_json(text: Column) -> Column:
    """The JSON value (VARIANT) of an answer: a fence around it is taken off; else what lies between the first and the last brace; else null."""

    def unfenced(t: Column) -> Column:
        return F.when(t.startswith("```json"), t.substr(F.lit(8), F.length(t))).when(t.startswith("```"), t.substr(F.lit(4), F.length(t))).otherwise(t)

    def unended(t: Column) -> Column:
        return strip(F.when(t.endswith("```"), t.substr(F.lit(1), F.length(t) - 3)).otherwise(t))

    def parsed(t: Column) -> Column:
        first, last = F.instr(t, "{"), F.length(t) - F.instr(F.reverse(t), "}") + 1
        inner = F.when((first > 0) & F.contains(t, F.lit("}")) & (last > first), t.substr(first, last - first + 1))
        return F.coalesce(F.try_parse_json(t), F.try_parse_json(inner))

    return let(let(let(strip(text), unfenced), unended), parsed)
