import hashlib
import unicodedata

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loomline.functions import template as chat
from loomline.functions import text as tx


def column(spark, f, values):
    df = spark.createDataFrame(list(enumerate(values)), "k int, t string")
    return [r.v for r in df.select("k", f(F.col("t")).alias("v")).orderBy("k").collect()]


SPACES = [chr(c) for c in range(0x3001) if chr(c).isspace()]


def test_whitespace_is_pythons(spark):
    assert len(SPACES) == 29
    texts = [s + "a" + s + "B" + s for s in SPACES] + ["", " ", "a", "​x​", "x\n"]
    assert column(spark, tx.strip, texts) == [t.strip() for t in texts]
    assert column(spark, tx.word_count, texts) == [len(t.split()) for t in texts]
    assert column(spark, tx.signature, [*texts, None]) == ["".join(t.lower().split()) for t in texts] + [""]
    assert column(spark, tx.text_hash, texts) == [hashlib.sha256(" ".join(t.strip().lower().split()).encode()).hexdigest() for t in texts]


def test_long_runs_of_whitespace(spark):
    run = "".join(SPACES) * 10000
    texts = [f"{run}A{run}b{run}", run, f"A{run}b", "a b", "a\tb", " a  b "]
    assert column(spark, tx.strip, texts) == [t.strip() for t in texts]
    assert column(spark, tx.normalized, texts) == ["a b", "", "a b", "a b", "a b", "a b"]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(st.sampled_from([*SPACES, *"aZé-ß1_\U0001f600"]), max_size=12), min_size=40, max_size=60))
def test_text_functions_on_random_texts(spark, texts):
    assert column(spark, tx.strip, texts) == [t.strip() for t in texts]
    assert column(spark, tx.normalized, texts) == [" ".join(t.strip().lower().split()) for t in texts]


def test_cleaning(spark):
    cases = {
        "ﬁnal opti-\nmization": "final optimization", "té-\n  àb": "téàb", "one\ntwo\n three   four ": "one two three four", "  x  ": "x", "": "",
        ">>> x = 1\n    y  =  2   \n": ">>> x = 1\n    y = 2", "use `a`  b\n\tc": "use `a` b\n\tc", "a = b\nf() c": "a = b\nf() c", "# title\nrest": "# title\nrest",
        "a = b; f()": "a = b; f()", "important\nimport": "important import", "from x\nimport y": "from x\nimport y", "from x\nexport y": "from x export y", "def f(a): pass\nz": "def f(a): pass\nz", "define f\nz": "define f z",
    }
    assert column(spark, tx.clean_segment, list(cases)) == list(cases.values())
    assert column(spark, tx.clean_text, ["a\nb\n\n  \n\n`c`\nd\n\n", None]) == ["a b\n\n`c`\nd", ""]
    assert column(spark, tx.nfkc, ["ﬁ", "a", None, "①"]) == [None if t is None else unicodedata.normalize("NFKC", t) for t in ["ﬁ", "a", None, "①"]]


def test_greetings(spark):
    cases = {"Hierarchical clustering": "erarchical clustering", "High bias": "gh bias", "Surely so": "ly so", "Sure, Hello! x": "Hello! x", "Hello! Certainly! y": "y", " hello!": "", "plain": "plain", "I'd be happy to help. Let's dive in. z": "z"}
    assert column(spark, tx.strip_greetings, list(cases)) == list(cases.values())


def test_difficulty_and_names(spark):
    labels = ["intermediate", "Easy one", "MED", "expert", "hard", "none", "", "beginner", "Advanced "]
    assert column(spark, tx.strict_difficulty, labels) == ["Intermediate", "Beginner", "Intermediate", "Advanced", "Advanced", None, None, "Beginner", "Advanced"]
    assert column(spark, tx.lenient_difficulty, [*labels, None])[-3:] == ["Beginner", "Advanced", "Intermediate"]
    assert column(spark, lambda c: tx.chunk_id(F.length(c)), ["a" * 5, "a" * 1234]) == ["chunk_005", "chunk_1234"]
    assert column(spark, tx.book_name, ["/x/My_nice-book.v2.pdf", "plain", "s3://b/.hidden"]) == ["My nice book.v2", "plain", ".hidden"]
    assert column(spark, lambda c: tx.duration(c.cast("double")), ["5.9", "65", "3700"]) == ["5s", "1m 5s", "1h 1m 40s"]


def test_headings_and_watermarks(spark):
    yes = ["Chapter 3: Trees", " PART iv. More", "12. The Big Picture", "chapter ٣"]
    no = ["Chapters 3", "12. the small", "12. Has 3 digits", "Part 4", "Chapter 1 " + "x" * 120, ""]
    assert column(spark, tx.is_heading, yes + no) == [True] * 4 + [False] * 6
    assert column(spark, tx.without_watermarks, ["a OCEANOFPDF.com b", "www.it-ebooks.info", "oceanofpdfxcom"]) == ["a  b", "", "oceanofpdfxcom"]


def test_fenced_json(spark):
    cases = ['```json\n{"a": 1}\n```', '```\n{"a": 1}```', 'so: {"a": 1} done', '{"a": 1', "}{", "[1]", "null", "", None, '{"a": "}"} tail', "```"]
    got = column(spark, lambda c: F.to_json(tx.fenced_json(c)), cases)
    assert got == ['{"a":1}', '{"a":1}', '{"a":1}', None, None, "[1]", "null", None, None, '{"a":"}"}', None]


def test_templates(spark):
    df = spark.createDataFrame([(" hi ", "yo\n")], "instruction string, response string")
    text = df.select(chat.chat_text(F.col("instruction"), F.col("response"), "S").alias("t"), chat.question_prompt(F.col("instruction"), "S", chat.LLAMA3).alias("p")).first()
    assert text.t == "<|im_start|>system\nS<|im_end|>\n<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\nyo<|im_end|>\n"
    assert text.p.startswith("<|begin_of_text|><|start_header_id|>system<|end_header_id|>\n\nS<|eot_id|>") and text.p.endswith("<|start_header_id|>assistant<|end_header_id|>\n\n")
