"""Secret scans with a password guess cost (operator 10).

Base kinds are patterns: ``assign`` (a credential's name, a sign and a value of
12 or more characters), ``access`` and ``hex`` keys. The method looks at all
credential-context values, also short ones and ones with other characters, and
adds a span of kind ``guess`` where guessing the value would cost
``min_cost`` orders of magnitude or more. The cost is the cheapest way to cut
the value into words, dates, repeats, keyboard walks and brute-force spans,
found by dynamic programming over its positions. Values that a base ``assign``
span covers whole are not reported again; one that goes on after the base span
is scored whole and has its own span beside it. Offsets are code points, ends
exclusive.

A value in quotes goes up to its closing quote, blanks and all; a quote that is
not closed before the next empty line opens none. A value without quotes ends at
a blank, a quote, a bracket, a comma or a semicolon. Values of all lengths are
scored; the cost alone decides.

Cases: a NULL text is an empty text and has no spans; repeated rows each give a
row; an empty table gives no rows; columns of other names pass
``redact`` unchanged and are not read by ``scan``.
"""

from __future__ import annotations

import hashlib
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbside.llm.common import as_bytes, slices, text_of

KINDS = ("assign", "access", "hex", "guess")
#: The base patterns.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
HEX_LONG = re.compile(r"[0-9a-f]{16,}")
#: Names that announce a credential, and the values that can follow: quoted (a
#: backslash keeps a quote from closing, unless none would close then), or plain.
_INSIDE = r"\n(?![\x20\t\r]*\n)|(?!(?P={0}))[^{1}\n]"
CONTEXT = re.compile(r"""(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|api_?key|credential)s?["']?\x20*(?:=>|:=|[:=])\x20*(?:"""
                     r"""(?P<q>\"{3}|'{3}|["'`])(?P<quoted>(?:\\[^\n]|""" + _INSIDE.format("q", r"\\") + r""")++)(?P=q)|"""
                     r"""(?P<r>["'`])(?P<raw>(?:""" + _INSIDE.format("r", "") + r""")++)(?P=r)|"""
                     r"""\u201c(?P<curly>(?:\n(?![\x20\t\r]*\n)|[^\u201c\u201d\n])++)\u201d|\u2018(?P<single>(?:\n(?![\x20\t\r]*\n)|[^\u2018\u2019\n])++)\u2019|"""
                     r"""["'`]*(?P<plain>[^\s"'`,;<>(){}\[\]]+))""",
                     re.I | re.A)

#: Words that guessers try first, most common first (fixed values).
COMMON_WORDS = ("password passwd pass admin root user guest test demo default changeme welcome login letmein master secret "
                "token access private public system server service manager oracle mysql postgres qwerty abc iloveyou "
                "sunshine princess dragon monkey football baseball shadow michael jordan superman batman trustno hello "
                "freedom whatever starwars summer winter spring autumn monday friday january december london paris "
                "berlin madrid company office internet computer windows linux android google apple samsung example "
                "sample dummy temp null none true false here your placeholder redacted hidden").split()
KEY_ROWS = ("`1234567890-=", "qwertyuiop[]\\", "asdfghjkl;'", "zxcvbnm,./")
LEET = str.maketrans("@4301!5$7", "aaeoiisst")
#: Runs of neighbouring code points: starts this far into one are never the cheapest.
DEEP = 128


def _near_keys() -> dict[str, str]:
    """Keys beside each key: in its row, and in the rows above and below."""
    near: dict[str, set] = {}
    for y, row in enumerate(KEY_ROWS):
        for x, key in enumerate(row):
            around = {(x - 1, y), (x + 1, y), (x, y - 1), (x + 1, y - 1), (x, y + 1), (x - 1, y + 1)}
            near[key] = {KEY_ROWS[j][i] for i, j in around if 0 <= j < len(KEY_ROWS) and 0 <= i < len(KEY_ROWS[j])}
    return {k: "".join(sorted(v)) for k, v in near.items()}


NEAR = _near_keys()
RANK = {w: i + 1 for i, w in enumerate(COMMON_WORDS)}
LONGEST_WORD = max(map(len, COMMON_WORDS))
DATE = re.compile(r"(?:(?:19|20)\d\d([-/._]?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12]\d|3[01])|(?:0[1-9]|[12]\d|3[01])([-/._]?)(?:0[1-9]|1[0-2])\2(?:19|20)\d\d|(?:19|20)\d\d)")


def _alphabet(text: str) -> int:
    size = 0
    for kind, n in ((str.islower, 26), (str.isupper, 26), (str.isdigit, 10), (lambda c: not c.isalnum(), 33)):
        if any(map(kind, text)):
            size += n
    return max(size, 10)


def guess_cost(value: str, limit: float = math.inf) -> float:
    """log10 of the guesses that the cheapest segmentation needs: exact below
    ``limit``, and otherwise some number that is not below it.

    Places that cost ``limit`` or more lead nowhere, which bounds the units of
    repeats. How far a unit repeats, a character runs and neighbouring code
    points go on is searched once for all starts. A character's run that starts
    deep inside the run is dearer than the longer one from where the run was
    entered, and a segment that ends inside a run, other than by the run's own
    characters, ends within its own word's, date's or unit's length of the
    run's start. So the time follows the length of the value."""
    n = len(value)
    if not n:
        return 0.0
    low, plain = value.lower(), value.lower().translate(LEET)
    per_char = math.log10(_alphabet(value))
    best = [0.0] + [math.inf] * n
    reach = 0
    run_from = run_to = way_from = way_to = 0
    same: dict[int, int] = {}  # unit -> first place from the present one where the value differs from itself a unit later
    deep = max(LONGEST_WORD, 10, n if limit == math.inf else int(limit / per_char) + 1)

    def offer(i: int, j: int, cost: float) -> None:
        # each segment beyond the first also has to be put in its place
        nonlocal reach
        cost += best[i] + (math.log10(2) if i else 0.0)
        if cost < best[j]:
            best[j] = cost
            if j > reach and cost < limit:
                reach = j

    for i in range(n):
        if i > reach:
            break
        if best[i] >= limit:
            continue
        offer(i, i + 1, per_char)  # brute force, a character at a time
        if i and best[i] + per_char < best[i + 1]:
            best[i + 1] = best[i] + per_char
            if best[i + 1] < limit:
                reach = max(reach, i + 1)
        for j in range(i + 2, min(n, i + LONGEST_WORD) + 1):
            rank = RANK.get(low[i:j]) or RANK.get(plain[i:j])
            if rank:
                cased = math.log10(2) if value[i:j] != low[i:j] else 0.0
                swapped = math.log10(4) if low[i:j] != plain[i:j] else 0.0
                offer(i, j, math.log10(rank + 1) + cased + swapped)
        date = DATE.match(value, i)
        if date:
            offer(i, date.end(), math.log10(365.25 * 120 if date.end() - i > 4 else 120))
        if i >= run_to:
            run_from, run_to = i, i + 1
            while run_to < n and value[run_to] == value[i]:
                run_to += 1
        if i - run_from <= deep:
            for k in range(i + 3, run_to + 1):
                offer(i, k, per_char + math.log10(k - i))
        units = (n - i) // 2 if limit == math.inf else min((n - i) // 2, int((limit - best[i]) / per_char))
        for unit in range(2, units + 1):
            k = same.get(unit, -1)
            if k < i:
                k = i
                while k + unit < n and value[k] == value[k + unit]:
                    k += 1
                same[unit] = k
            times = 1 + (k - i) // unit
            if times > 1:
                offer(i, i + unit * times, unit * per_char + math.log10(times))
        j, step, turns = i + 1, 0, 0
        while j < n and low[j] in NEAR.get(low[j - 1], ""):
            way = ord(low[j]) - ord(low[j - 1])
            turns += j > i + 1 and way != step
            if best[i] + turns * math.log10(4) >= limit:
                break
            step = way
            j += 1
            if j - i >= 3:
                offer(i, j, math.log10(len(NEAR)) + math.log10(j - i) + turns * math.log10(4))
        if i >= way_to - 1:
            way_from, way_to = i, i + 1
            while way_to < n and abs(ord(low[way_to]) - ord(low[way_to - 1])) == 1 and (
                    way_to == i + 1 or ord(low[way_to]) - ord(low[way_to - 1]) == ord(low[i + 1]) - ord(low[i])):
                way_to += 1
        if i - way_from <= DEEP:
            first = math.log10(2 * _alphabet(value[i]))
            for k in range(i + 3, way_to + 1):
                offer(i, k, first + math.log10(k - i))
    return best[n]


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base kinds, sorted."""
    found = []
    if ":" in text or "=" in text:
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    # A run of 16 or more is a whole leftmost match of the pattern itself.
    found += [(m.start(), 2, m.end()) for m in HEX_LONG.finditer(text)]
    return sorted(found)


def all_spans(text: str, min_cost: float = 8.0) -> tuple[list, list]:
    """(base spans, base spans and those that the method adds)."""
    base = base_spans(text)
    added = []
    if ":" in text or "=" in text:
        taken = [(a, b) for a, kind, b in base if kind == 0]
        at = 0
        for m in CONTEXT.finditer(text):
            a, b = m.span(m.lastgroup)
            while at < len(taken) and taken[at][1] <= a:
                at += 1
            if at < len(taken) and taken[at][0] <= a and b <= taken[at][1]:
                continue
            if guess_cost(text[a:b], min_cost) >= min_cost:
                added.append((a, 3, b))
    return base, sorted(base + added)


def _listed(spans) -> str:
    return ",".join(f"{KINDS[kind]}:{a}:{b}" for a, kind, b in spans)


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_cost: float = 8.0) -> DataFrame:
    """Per row: id, counts of the base kinds, the digest of the base spans and
    all spans. A narrow pass over whole texts."""
    def run(batches):
        for part in slices(batches, 1):
            rows = []
            for raw in part.column(1).to_pylist():
                base, spans = all_spans(text_of(raw), min_cost)
                kinds = [k for _, k, _ in base]
                rows.append((*(kinds.count(k) for k in range(3)), hashlib.sha256(_listed(base).encode()).hexdigest(), _listed(spans)))
            columns = list(zip(*rows))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), *(pa.array(c, pa.int64()) for c in columns[:3]), *(pa.array(c, pa.string()) for c in columns[3:])],
                names=["row", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    id_type = df.select(F.col(id_col).alias("i")).schema["i"].dataType.simpleString()
    out = (df.select(F.col(id_col).alias("row"), as_bytes(text_col).alias("raw"))
           .mapInArrow(run, f"row {id_type}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"))
    return out.select(F.col("row").alias(id_col), *out.columns[1:])


def masked(text: str, min_cost: float = 8.0, mask: str = "[SECRET]") -> str:
    """The text with every span replaced; overlapping spans are one."""
    out, at = [], 0
    for a, _, b in all_spans(text, min_cost)[1]:
        if b <= at:
            continue
        if a >= at:
            out += [text[at:a], mask]
        at = b
    return text if not out else "".join([*out, text[at:]])


def redact(df: DataFrame, text_col: str = "text", length_col: str | None = "n_chars", min_cost: float = 8.0,
           mask: str = "[SECRET]") -> DataFrame:
    """All rows and columns, secrets in the text replaced by ``mask``; where
    that changes a text, ``length_col`` (if there is one) follows it."""
    def run(batches):
        for batch in batches:
            raw = batch.column(1).to_pylist()
            new = [None if t is None else masked(text_of(t), min_cost, mask) for t in raw]
            changed = [n if n is not None and n != text_of(t) else None for n, t in zip(new, raw)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(changed, pa.string())], names=["whole", "changed"])

    packed = df.select(F.struct("*").alias("whole"), as_bytes(text_col).alias("raw"))
    out = packed.mapInArrow(run, T.StructType([packed.schema["whole"], T.StructField("changed", T.StringType())]))
    columns = []
    for field in df.schema.fields:
        value = F.col("whole").getField(field.name)
        if field.name == text_col:
            value = F.coalesce(F.col("changed"), value)
        elif field.name == length_col:
            value = F.when(F.col("changed").isNotNull() & value.isNotNull(), F.length("changed").cast(field.dataType)).otherwise(value)
        columns.append(value.alias(field.name))
    return out.select(*columns)
