"""Secret scans: pattern candidates, then a random forest that removes false positives.

Candidates are known key formats, values behind an assignment, long runs
of key characters with a digit (numbers too) and the parts between the = in them, and private-key blocks.
Candidates may overlap and each is judged; what is judged a secret is redacted,
of NAME=value the value alone. Each gets features of its length, character transitions
(class changes, entropy, bigrams against ordinary words), dictionary coverage,
path and neighbouring words; a forest trained from labelled findings says how
likely it is a secret. Training is on the driver, on at most `MAX_FINDINGS`
labelled findings (a documented bound); scanning is one pass without a shuffle.

`default_findings` makes the labelled findings that the registered query trains
from: keys, tokens and passwords in the contexts that leak them, against hashes,
identifiers, numbers, placeholders and long words.

Defined results: a null or empty text has no candidates and stays as it is; a
null path counts as an empty one; repeated rows are scanned each; other columns
pass through; an empty table gives an empty table.
"""

from __future__ import annotations

import math
import random
import re
from collections import Counter
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_FINDINGS = 20_000
MARK = "<SECRET>"
RUN = re.compile(r"[A-Za-z0-9_+/=\-]{16,}")
ASSIGN = re.compile(r"[:=][ \t]*[\"'`]?")
VALUE = re.compile(r"[^\s\"'`,;<>()]{8,}")
PART = re.compile(r"[^=]+=*")
NAME = re.compile(r"[A-Za-z0-9_.\-]+=+")
BEGIN, END = (re.compile(rf"-----{x} [A-Z ]{{0,40}}PRIVATE KEY-----") for x in ("BEGIN", "END"))
KEYWORD = re.compile(r"(?i)(passw(?:or)?d|pwd|secret|token|api[_\- ]?key|access[_\- ]?key|private[_\- ]?key|auth|credential|bearer)")
HASHED = re.compile(r"(?i)\b(commit|sha\d*|md5|checksum|digest|etag|uuid|guid|revision|hash|build|version|isbn|doi)\b")
FAKE = re.compile(r"(?i)(example|sample|dummy|placeholder|your|changeme|xxxx|todo|redacted|test|lorem|foobar|insert|null|none)")
FORMAT = re.compile(r"^(AKIA[0-9A-Z]{16}|ASIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[0-9A-Za-z\-]{10,}|sk[-_](live|test)?[-_]?[A-Za-z0-9]{20,}|AIza[0-9A-Za-z_\-]{35}|eyJ[A-Za-z0-9_\-]{10,}.*|glpat-[A-Za-z0-9_\-]{20,}|-----BEGIN [A-Z ]*PRIVATE KEY-----[\s\S]*)$")
INNER = re.compile(r"(?<![A-Za-z0-9])(?:A[KS]IA[0-9A-Z]{16}(?![0-9A-Za-z])|gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[0-9A-Za-z\-]{10,}|sk[-_](?:live|test)?[-_]?[A-Za-z0-9]{20,}|AIza[0-9A-Za-z_\-]{35}(?![0-9A-Za-z_\-])|eyJ[A-Za-z0-9_\-]{10,}(?:\.[A-Za-z0-9_\-]+)*|glpat-[A-Za-z0-9_\-]{20,})")
DOTTED = re.compile(r"[A-Za-z0-9_+/=.\-]*")
UUID = re.compile(r"(?i)^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$")
QUIET_PATH = re.compile(r"(?i)(test|example|fixture|mock|docs?/|readme|vendor|node_modules)")
DICTIONARY = frozenset(
    "able about above access account after again against also always and another any are area around back because been before being below between both build business call case change child city class clean client close cloud code come common company config connect content control could count country create data date debug default delete different does down each early element else email end enough error even event every example fact family fast field file filter final find first follow form format found from full function get give given good great group had hand handle has have head health help here high home host house however http https important include index information input insert into item just keep key kind know label large last late later leave left less level life light like line link list little local long look machine made main make manager many map match matter may mean member merge message method might model module more most move much must name need network never new next node not note now number object off office often old once one only open option order other our out output over own page parent part password path people person place plan play point power present print problem process program project public question queue read reader record remove report request resource response result return right room run same save school search second secret section see seem select send server service session set several should show side simple since size small some source space special start state status still stop story string study such sure system table take task tell test text than that the their them then there these they thing think this those three through time title token too turn two type under unit until update upload upper use used user using util value version very view wait walk want was water way web week well were what when where which while white who why will window with without word work world would write writer year yes you young your".split()
)
FEATURES = ("length", "log_length", "entropy", "digits", "upper", "lower", "other", "hex", "class_changes", "bigrams", "longest_letters", "distinct", "dictionary", "known_format", "uuid", "keyword_before", "hash_before", "fake_inside", "fake_near", "assigned", "quoted", "quiet_path", "word_like_neighbours")


@lru_cache(maxsize=1)
def _bigrams() -> dict[str, float]:
    counts = Counter(a + b for w in DICTIONARY for a, b in zip(w, w[1:], strict=False))
    total = sum(counts.values())
    return {k: math.log2(v * 676 / total) for k, v in counts.items()}


def _coverage(value: str) -> float:
    """Share of the letters that dictionary words of four letters and more cover, longest first from the left."""
    low, i, hit = value.lower(), 0, 0
    n = len(low)
    while i < n:
        for k in range(min(11, n - i), 3, -1):
            if low[i : i + k] in DICTIONARY:
                hit += k
                i += k
                break
        else:
            i += 1
    return hit / max(1, n)


def features(value: str, before: str, after: str, path: str) -> list[float]:
    """What the forest reads of a candidate: all of itself, 48 characters on either side, and its path."""
    v, n = value, len(value)
    counts = Counter(v)
    entropy = -sum(c / n * math.log2(c / n) for c in counts.values())
    kinds = ["d" if c.isdigit() else "u" if c.isupper() else "l" if c.isalpha() else "o" for c in v]
    share = Counter(kinds)
    table = _bigrams()
    pairs = [table.get(a + b, -4.0) for a, b in zip(v.lower(), v.lower()[1:], strict=False)]
    letters = max((len(x) for x in re.findall(r"[A-Za-z]+", v)), default=0)
    near = re.findall(r"[^\W\d_]+", before[-24:] + " " + after[:24])
    return [
        n, math.log2(n), entropy, share["d"] / n, share["u"] / n, share["l"] / n, share["o"] / n,
        sum(c in "0123456789abcdefABCDEF" for c in v) / n, sum(a != b for a, b in zip(kinds, kinds[1:], strict=False)) / n,
        sum(pairs) / max(1, len(pairs)), letters, len(counts) / n, _coverage(v), float(bool(FORMAT.match(v))), float(bool(UUID.match(v))),
        float(bool(KEYWORD.search(before[-32:]))), float(bool(HASHED.search(before[-32:]))), float(bool(FAKE.search(v))), float(bool(FAKE.search(before[-24:]))),
        float(bool(re.search(r"[:=]\s*[\"'`]?$", before))), float(before[-1:] in "\"'`" and before != ""), float(bool(QUIET_PATH.search(path))), min(4, len(near)),
    ]


def _digits(value: str) -> bool:
    return any(c in value for c in "0123456789")


def _blocks(text: str):
    """Spans of private-key blocks, from a BEGIN to the next END."""
    at = 0
    while (a := BEGIN.search(text, at)) and (b := END.search(text, a.end())):
        yield a.start(), b.end()
        at = b.end()


def candidates(text: str) -> list[tuple[int, int]]:
    """Spans that may be secrets, by start, of equal starts the longest first; spans may overlap."""
    spans = set(_blocks(text))
    known = 0
    for m in RUN.finditer(text):
        a, v = m.start(), m.group()
        if _digits(v):
            spans.add(m.span())
            if "=" in v.rstrip("="):
                spans |= {(a + k.start(), a + k.end()) for k in PART.finditer(v) if len(k.group()) >= 16 and _digits(k.group())}
        if m.end() > known:
            at, stop = max(a, known), DOTTED.match(text, m.end()).end() if "eyJ" in v else m.end()
            while k := INNER.search(text, at, stop):
                spans.add(k.span())
                at = known = k.end()
            known = max(known, stop)
    if "=" in text or ":" in text:
        at = 0
        while m := ASSIGN.search(text, at):
            at = m.end()
            if KEYWORD.search(text[max(0, m.start() - 32) : m.start()]) and not text.startswith("//", at) and (v := VALUE.match(text, at)):
                spans.add(v.span())
                at = v.end()
    return sorted(spans, key=lambda s: (s[0], -s[1]))


def secrets(text: str, spans: list[tuple[int, int]], scores: np.ndarray, threshold: float) -> list[tuple[int, int, float]]:
    """The spans that are judged secrets, without overlaps: of NAME=value and its value the value, of others the union."""
    found = [(a, b, float(p)) for (a, b), p in zip(spans, scores, strict=True) if p >= threshold]
    last: dict[int, int] = {}  # start of the latest-starting span by end
    out: list[tuple[int, int, float]] = []
    for a, b, _ in found:
        last[b] = a
    for a, b, p in found:
        if last[b] > a and NAME.fullmatch(text, a, last[b]):
            continue
        if out and a < out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]), max(p, out[-1][2]))
        else:
            out.append((a, b, p))
    return out


class Forest:
    """A random forest in arrays: bootstrap samples, sqrt features a split, Gini, fixed seed."""

    def __init__(self, n_trees: int = 48, depth: int = 12, least: int = 3, seed: int = 42):
        self.n_trees, self.depth, self.least, self.seed = n_trees, depth, least, seed
        self.trees: list[tuple[np.ndarray, ...]] = []

    def fit(self, x: np.ndarray, y: np.ndarray) -> Forest:
        rng = np.random.default_rng(self.seed)
        for _ in range(self.n_trees):
            pick = rng.integers(0, len(x), len(x))
            self.trees.append(self._tree(x[pick], y[pick], rng))
        return self

    def _tree(self, x, y, rng):
        feature, cut, left, right, value = [], [], [], [], []
        n_try = max(1, int(math.sqrt(x.shape[1])) + 1)

        def grow(rows, depth):
            k = len(feature)
            mean = float(y[rows].mean())
            for store, v in ((feature, -1), (cut, 0.0), (left, k), (right, k), (value, mean)):
                store.append(v)
            if depth == 0 or len(rows) < 2 * self.least or mean in (0.0, 1.0):
                return k
            best = None
            for f in rng.choice(x.shape[1], n_try, replace=False):
                order = rows[np.argsort(x[rows, f], kind="stable")]
                v, c = x[order, f], np.cumsum(y[order])
                n = np.arange(1, len(order))
                ok = (v[1:] > v[:-1]) & (n >= self.least) & (len(order) - n >= self.least)
                if not ok.any():
                    continue
                a, b = c[:-1] / n, (c[-1] - c[:-1]) / (len(order) - n)
                cost = np.where(ok, n * a * (1 - a) + (len(order) - n) * b * (1 - b), np.inf)
                i = int(cost.argmin())
                if best is None or cost[i] < best[0]:
                    best = (cost[i], f, (v[i] + v[i + 1]) / 2)
            if best is None:
                return k
            feature[k], cut[k] = int(best[1]), float(best[2])
            low = x[rows, best[1]] <= best[2]
            left[k], right[k] = grow(rows[low], depth - 1), grow(rows[~low], depth - 1)
            return k

        grow(np.arange(len(x)), self.depth)
        return tuple(np.array(a) for a in (feature, cut, left, right, value))

    def predict(self, x: np.ndarray) -> np.ndarray:
        total = np.zeros(len(x))
        for feature, cut, left, right, value in self.trees:
            at = np.zeros(len(x), int)
            for _ in range(self.depth + 1):
                f = feature[at]
                at = np.where(f < 0, at, np.where(x[np.arange(len(x)), f] <= cut[at], left[at], right[at]))
            total += value[at]
        return total / max(1, len(self.trees))


def default_findings(n: int = 6000, seed: int = 7) -> list[tuple[str, str, str, str, int]]:
    """(value, before, after, path, label) of n labelled findings, half of them secrets."""
    r, numbers = random.Random(seed), random.Random(seed + 1_000_003)
    letters = "abcdefghijklmnopqrstuvwxyz"
    syllables = "the an er on re ha ed en ou st ti nd es or at eau ment sch lich keit ado cion ra el pf tion ing ble ly qua vi".split()
    pool = sorted(DICTIONARY)
    from_ = lambda alphabet, k: "".join(r.choice(alphabet) for _ in range(k))
    hexed = lambda k: from_("0123456789abcdef", k)
    base = letters + letters.upper() + "0123456789"
    prose = lambda k: " ".join(r.choice(pool) if r.random() < 0.5 else "".join(r.choice(syllables) for _ in range(r.randint(1, 4))) for _ in range(k)) + " "
    names = ("token", "api_key", "secret", "password", "access_key", "apikey", "auth_token", "client_secret", "SECRET_KEY", "pwd", "credential", "API key", "GITHUB_TOKEN", "DB_PASSWORD", "AWS_SECRET_ACCESS_KEY")
    plain = ("AWS_KEY=", "KEY=", "key: ", "GH=", "export X=")  # names without a keyword
    paths = ("src/app.py", "config/settings.yml", ".env", "deploy/main.tf", "src0", "web", "forum/12", "tests/test_app.py", "docs/readme.md", "")
    pem = lambda kind, body: f"-----BEGIN {kind}PRIVATE KEY-----\n{body}\n-----END {kind}PRIVATE KEY-----"
    lines = lambda v: "\n".join(v[i : i + 64] for i in range(0, len(v), 64))
    kinds = ("", "RSA ", "EC ", "OPENSSH ")
    junk = ("", "###", "%%%", "&&&", "!!", ",", ".")
    out = []
    for k in range(n):
        secret = k % 2 == 0
        if secret:
            value = r.choice([
                lambda: hexed(r.choice((32, 40, 40, 48, 64))), lambda: from_(base, r.randint(20, 64)), lambda: "AKIA" + from_(letters.upper() + "0123456789", 16), lambda: "ghp_" + from_(base, 36),
                lambda: f"xoxb-{from_('0123456789', 11)}-{from_(base, 24)}", lambda: "sk_live_" + from_(base, 24), lambda: from_(base + "+/", 40), lambda: "eyJ" + from_(base + "_-", r.randint(40, 120)), lambda: from_(base + "!@#%^*_-", r.randint(10, 20)), lambda: "AIza" + from_(base + "_-", 35),
                lambda: from_(base + r.choice(("+/", "_-")), int(2 ** r.uniform(6, 12))), lambda: "eyJ" + from_(base + "_-", int(2 ** r.uniform(7, 12))),
                lambda: pem(r.choice(kinds), lines("M" + from_(base + "+/", r.choice((120, 160, 400, 840, 1200, 1600, 2400))) + r.choice(("", "=", "==")))),
            ])()
            known = bool(FORMAT.match(value))
            sign, quote = r.choice((" = ", "=", ": ", ":")), r.choice(('"', "'", ""))
            before = prose(r.randint(0, 6)) + (r.choice(names) + sign + quote if not known or r.random() < 0.6 else r.choice(("", "", *plain)))
            after = (quote if before.endswith(quote) else "") + r.choice(junk) + " " + prose(r.randint(0, 6))
        else:
            kind = r.randrange(14)
            named = r.choice(names) + r.choice((" = ", "=", ": ")) + r.choice(('"', ""))
            before = prose(r.randint(0, 6))
            if kind == 0:
                value, before = hexed(r.choice((32, 40, 64))), before + r.choice(("commit ", "sha256: ", "md5 ", "checksum=", "etag: ", "revision ", "digest: sha1 "))
            elif kind == 1:
                value, before = f"{hexed(8)}-{hexed(4)}-{hexed(4)}-{hexed(4)}-{hexed(12)}", before + r.choice(("uuid ", "guid: ", "", "id="))
            elif kind == 2:
                value, before = r.choice(("xxxxxxxxxxxxxxxx1234", "your-api-key-here-1", "CHANGEME_CHANGEME_1", "example_token_123456", "insert-your-token-here", "dummy-secret-value-1", "0000000000000000000a", "<redacted-0123456789>", "test1234test1234test")), before + named
            elif kind == 3:
                value = "_".join(r.choice(pool) for _ in range(r.randint(3, 6))) + str(r.randint(0, 99))
                before += r.choice(("", named, "name: "))
            elif kind == 4:
                value = "".join(r.choice(pool).title() for _ in range(r.randint(3, 6))) + str(r.randint(0, 9))
            elif kind == 5:
                value = "/".join(r.choice(pool) for _ in range(r.randint(3, 6))) + "/" + str(r.randint(1, 9999))
            elif kind == 6:
                value = f"{r.randint(1990, 2030)}-{r.randint(10, 12)}-{r.randint(10, 28)}T{r.randint(10, 23)}-{r.randint(10, 59)}-{r.randint(10, 59)}Z"
            elif kind == 7:
                value = "-".join(from_("0123456789", 4) for _ in range(r.randint(4, 5))) + r.choice(("", "=", "-"))
                if numbers.random() < 0.6:  # card, account and telephone numbers
                    value, before = "".join(numbers.choice("0123456789") for _ in range(numbers.choice((16, 16, 17, 18, 20)))), before + numbers.choice(("", "card ", "id=", "order: ", "call "))
            elif kind == 8:
                value = "".join(r.choice(syllables) for _ in range(r.randint(7, 14))) + r.choice(("1", "2", "-2", "_3"))
            elif kind == 9:
                value, before = hexed(r.choice((32, 40, 40))), before + r.choice(("", "see ", "at ", "build ", "version "))
            elif kind == 10:
                value, before = hexed(r.choice((32, 40, 40))), before + r.choice(("id=", "ref=", "node=", "trace_id=", "key=", "v=", "commit=", "sha="))
            elif kind == 12:
                value, before = from_(base + "+/", int(2 ** r.uniform(8, 13))) + r.choice(("", "=", "==")), before + r.choice(("data:image/png;base64,", "base64,", "src=", "content: ", "", "data = \"", "body="))
            elif kind == 11:
                value = pem(r.choice(kinds), r.choice(("...", "your key here", "<insert the private key here>", "\n".join(prose(r.randint(4, 9)).strip() for _ in range(r.randint(1, 12))), "xxxx" * r.randint(4, 200), "REDACTED")))
                before += r.choice(("", named))
            else:
                value, before = r.choice(pool) + r.choice(pool), before + r.choice(("password: ", "token = ", "secret: ", "auth: ", "key = "))
            after = r.choice(("", '"')) + " " + prose(r.randint(0, 6))
        out.append((value, before[-48:], after[:48], r.choice(paths), int(secret)))
    return out


def train(findings: list[tuple[str, str, str, str, int]] | DataFrame | None = None) -> Forest:
    """A forest from labelled findings (value, before, after, path, label); of a DataFrame the MAX_FINDINGS rows of smallest hash."""
    if findings is None:
        return _default_forest()
    if isinstance(findings, DataFrame):
        rows = findings.select("value", "before", "after", "path", "label").dropna(subset=["value", "label"]).filter("value <> ''")
        findings = [tuple(x) for x in rows.orderBy(F.xxhash64("value", "before", "after"), "value").limit(MAX_FINDINGS).collect()]
    x = np.array([features(v, b or "", a or "", p or "") for v, b, a, p, _ in findings[:MAX_FINDINGS]])
    y = np.array([int(f[4]) for f in findings[:MAX_FINDINGS]])
    return Forest().fit(x, y)


@lru_cache(maxsize=1)
def _default_forest() -> Forest:
    return train(default_findings())


def judged(text: str, path: str, forest: Forest) -> tuple[list[tuple[int, int]], np.ndarray]:
    spans = candidates(text)
    if not spans:
        return spans, np.zeros(0)
    x = np.array([features(text[a:b], text[max(0, a - 48) : a], text[b : b + 48], path) for a, b in spans])
    return spans, forest.predict(x)


def cut(text: str, found: list[tuple[int, int, float]], mark: str) -> str:
    parts, at = [], 0
    for a, b, _ in found:
        parts += [text[at:a], mark]
        at = b
    return "".join([*parts, text[at:]])


def scan(df: DataFrame, text: str = "text", path: str = "source", forest: Forest | None = None, threshold: float = 0.5, redacted: str | None = None, mark: str = MARK, out: str = "scan") -> DataFrame:
    """df with a struct column: n_candidates, n_secrets, spans (code-point start, end, probability of each secret); with `redacted`, also that column: the text with its secrets replaced by the mark."""
    if clash := {out, redacted if redacted != text else None} & set(df.columns):
        raise ValueError(f"{sorted(clash)} are columns already")
    model = df.sparkSession.sparkContext.broadcast(forest or train())
    fields = "n_candidates long, n_secrets long, spans array<struct<start: int, end: int, probability: double>>" + (", redacted string" if redacted else "")

    @F.pandas_udf(f"struct<{', '.join(x.replace(' ', ': ', 1) for x in re.split(r', (?=[a-z_]+ (?:long|array|string))', fields))}>")
    def run(texts: pd.Series, paths: pd.Series) -> pd.DataFrame:
        rows = []
        for t, p in zip(texts, paths, strict=True):
            spans, scores = judged(t or "", p or "", model.value)
            found = secrets(t or "", spans, scores, threshold)
            rows.append([len(spans), len(found), [dict(zip(("start", "end", "probability"), x, strict=True)) for x in found], *([None if t is None else cut(t, found, mark)] if redacted else [])])
        return pd.DataFrame(rows, columns=["n_candidates", "n_secrets", "spans", *(["redacted"] if redacted else [])])

    found = df.withColumn(out, run(F.col(text), F.col(path).cast("string")))
    return found.withColumn(redacted, F.col(f"{out}.redacted")) if redacted else found


def report(df: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str = "source") -> DataFrame:
    """doc_id, n_candidates, n_secrets, spans of every document."""
    slim = df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("__t"), F.col(path).alias("__p"))
    return scan(slim, "__t", "__p", out="__scan").select("doc_id", "__scan.n_candidates", "__scan.n_secrets", "__scan.spans")


def redact(df: DataFrame, text: str = "text", path: str = "source") -> DataFrame:
    """df with the secrets in its texts replaced."""
    return scan(df, text, path, redacted=text, out="__scan").select(*df.columns)
