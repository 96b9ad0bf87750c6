"""Secret scans: fixed patterns, and a battery of randomness tests on other long runs.

A run of characters is held to be a secret if it looks like random symbols of the encoding
it seems to be in (uniformity, runs and serial correlation are all believable) and if an
ordinary word or number would hardly look like that (a p-value, held to a false-discovery
rate within the text; longer runs get more weight, as the tests say more about them).
A run ends at "=", so the value of name=value is tested by itself. Digits only are never
held to be a secret, as an ordinary number looks the same.
"""

from __future__ import annotations

import functools
import hashlib
import math
import re
import string
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import extended

# Fixed values of the scan contract: kinds in order, patterns, shortest lengths.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(
    r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_LENGTH, ACCESS_LENGTH = 6, 20

KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
RUN = re.compile(r"[A-Za-z0-9+/_-]{18,}={0,2}")
RUN_LENGTH = 20  # with padding
ENCODINGS = (  # by size
    ("hex", "0123456789abcdef"),
    ("hex", "0123456789ABCDEF"),
    ("small", "abcdefghijklmnopqrstuvwxyz"),
    ("capital", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    ("base32", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("base36", "0123456789abcdefghijklmnopqrstuvwxyz"),
    ("base36", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    ("letters", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"),
    ("base62", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"),
    ("base64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
    ("base64url", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"),
)
# Bits that a letter (column) costs after another (row) in ordinary text, in quarters (0-9, a-z):
# counted over the words of the given sf0.1 texts and of Python's standard library in equal
# parts; a tenth of the weight is even, so that no rare pair decides alone.
LETTER_PAIRS = (
    "pmijmuorhvrfj9onueebhrrtqv",
    "htmr8vvwlhw7tvgqwnouhwvwgw",
    "hvruftw8dwhgsvauvnpenuvwtw",
    "gnum5uumcvwlwmdvwmjjkvqvsw",
    "frjgklsqivueobnoradhpqrlsr",
    "essphgsrbwujsp8rwdljhuuwru",
    "eoru6vnigwtkrijrwjdjiqqwws",
    "answ6wtjgwtmvkgtvlkhrtowvt",
    "nqinfjntrwvkk7dpunedvqvswq",
    "5wqv7wwwqwsvwwdqwvqvgwwwvw",
    "musp3vovfwwgvmspvpgsqvhwsw",
    "ettn8bvwewwfvuhrwujmlvvwdw",
    "bkvr6vwwewuqntfdwtkqlvvwtw",
    "gnjbcqdljvrmslfrtnhboqpwuu",
    "qnlisgrwlvsnk7nlvbjjdrovwv",
    "9vrqbhwsiwufutdiwdoflwvwjw",
    "wwvvwwwwvwwuwtwtvstw1wvvww",
    "eooq6ulmgvronhfrvihgmrqwnu",
    "lsht8vrehusprrkmtqg8kvswow",
    "hrrrcuv6bwuqtqgswhlllurvon",
    "kmnt9nqqlwugjbmjtdhfustfwu",
    "9vvw5vwwawwvsvhvwvvuwvwwww",
    "cuuqhvw5awwrvnjvwiovwvtwww",
    "fpaqemwtgwwmovjdplp8vpwqqv",
    "jmprdtwjhwwlofgbvmbbvpkuut",
    "immr9uoqhsqopslqsqnm5qwwuq",
)


@dataclass(frozen=True)
class Battery:
    """``level``: below it a test calls a run not random. ``rate``: false discoveries.

    ``change_rate``: how often the kind of character (capital, small, digit) changes
    from one to the next in ordinary text, the null hypothesis of the p-value. A capital is
    followed by another kind in ``after_capital`` of cases.
    """

    level: float = 0.001
    rate: float = 0.001
    change_rate: float = 0.15
    after_capital: float = 0.6


def _upper_tail(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def infer_encoding(run: str) -> str | None:
    """Symbols of the smallest alphabet that holds the run (padding cut off)."""
    present = set(run)
    return next((symbols for _, symbols in ENCODINGS if present <= set(symbols)), None)


def uniformity(run: str, symbols: str) -> float:
    """Upper tail of chi-squared against equal shares, by the cube-root normal approximation."""
    n, k = len(run), len(symbols)
    x = k / n * sum(run.count(c) ** 2 for c in set(run)) - n
    df = k - 1
    return _upper_tail(((x / df) ** (1 / 3) - (1 - 2 / (9 * df))) / math.sqrt(2 / (9 * df)))


def runs(run: str, symbols: str) -> float:
    """Two-sided Wald-Wolfowitz test of symbols in the lower and the upper half."""
    half = len(symbols) // 2
    sides = [symbols.index(c) < half for c in run]
    a, n = sum(sides), len(run)
    b = n - a
    if not a or not b:
        return 2.0 ** (1 - n)
    seen = 1 + sum(x != y for x, y in zip(sides, sides[1:]))
    mean = 2 * a * b / n + 1
    variance = (mean - 1) * (mean - 2) / (n - 1)
    return 1.0 if variance <= 0 else 2 * _upper_tail(abs(seen - mean) / math.sqrt(variance))


def serial(run: str, symbols: str) -> float:
    """Two-sided test of the correlation of each symbol's number with the next one's."""
    v = [symbols.index(c) for c in run]
    mean = sum(v) / len(v)
    spread = sum((x - mean) ** 2 for x in v)
    if not spread:
        return 0.0
    r = sum((x - mean) * (y - mean) for x, y in zip(v, v[1:])) / spread
    return 2 * _upper_tail(abs(r) * math.sqrt(len(v)))


@functools.cache
def _costs(change_rate: float, after_capital: float) -> dict[str, float]:
    """Bits of the second of two characters in ordinary text: its kind, then the character."""
    kinds = (string.digits, string.ascii_lowercase, string.ascii_uppercase)
    out = {}
    for k, firsts in enumerate(kinds):
        change = after_capital if k == 2 else change_rate
        for j, seconds in enumerate(kinds):
            kind = -math.log2(1 - change if j == k else change / 2)
            for a in firsts:
                for b in seconds:
                    if not j:
                        own = math.log2(10)
                    elif not k:
                        own = math.log2(26)
                    else:
                        own = int(LETTER_PAIRS[ord(a.lower()) - 97][ord(b.lower()) - 97], 36) / 4
                    out[a + b] = kind + own
    return out


def ordinary(run: str, symbols: str, battery: Battery = Battery()) -> float:
    """P-value under ordinary text, against random symbols of the encoding.

    The ratio of the two likelihoods is over 1 / p with probability p at most in ordinary
    text, whatever the length (Markov's inequality); it is divided by the number of encodings
    that the run could have been held to be in. Signs are left out with the step after them, as
    they join the parts of paths and names.
    """
    costs = _costs(battery.change_rate, battery.after_capital)
    each = math.log2(sum(c.isalnum() for c in symbols))
    bits = sum(costs[a + b] - each for a, b in zip(run, run[1:]) if a + b in costs)
    return min(1.0, len(ENCODINGS) * 2.0 ** -max(bits, 0.0))


def _merged(spans: list[tuple[int, str, int]]) -> list[tuple[int, int]]:
    """The stretches that spans cover, in order and apart."""
    out: list[tuple[int, int]] = []
    for start, _, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _uncovered(start: int, end: int, covered: list[tuple[int, int]], i: int) -> Iterator[tuple[int, int]]:
    """The parts of a run outside of ``covered``, of which ``i`` is the first that ends behind its start."""
    while i < len(covered) and covered[i][0] < end:
        if covered[i][0] > start:
            yield start, covered[i][0]
        start = max(start, covered[i][1])
        i += 1
    if start < end:
        yield start, end


def _candidates(text: str, taken: list[tuple[int, str, int]]) -> Iterator[tuple[int, int, str]]:
    """Long runs, and what is long of those that other spans cover in part; one walk along both lists."""
    covered, i = _merged(taken), 0
    for m in RUN.finditer(text):
        end = m.start() + len(m.group().rstrip("="))
        while i < len(covered) and covered[i][1] <= m.start():
            i += 1
        for s, e in _uncovered(m.start(), end, covered, i):
            run = text[s:e]
            if e - s + (m.end() - end) * (e == end) >= RUN_LENGTH and not run.isdigit():
                yield s, e, run


def _random_spans(text: str, taken: list[tuple[int, str, int]], battery: Battery) -> list[tuple[int, int]]:
    tested = []
    for start, end, run in _candidates(text, taken):
        symbols = infer_encoding(run)
        if symbols is None or any(test(run, symbols) < battery.level for test in (uniformity, runs, serial)):
            continue
        tested.append((ordinary(run, symbols, battery), start, end))
    # Weighted Benjamini-Hochberg: p over weight, weights in proportion to length, mean 1.
    mean = sum(e - s for _, s, e in tested) / len(tested) if tested else 1.0
    ranked = sorted((p * mean / (e - s), s, e) for p, s, e in tested)
    last = max((i for i, (q, _, _) in enumerate(ranked, 1) if q <= battery.rate * i / len(ranked)), default=0)
    return [(s, e) for _, s, e in ranked[:last]]


def scan(text: str | None, battery: Battery | None = Battery()) -> list[tuple[int, str, int]]:
    """(start, kind, end) of all spans, by start and then by kind; without battery base ones only."""
    if not text:
        return []
    found: list[tuple[int, str, int]] = []
    lowered = text.lower()
    if any(k in lowered for k in KEYWORDS):  # cheaper than the pattern, which needs one of them
        found += [(m.start(), "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LENGTH]
    if "AKIA" in text:
        found += [(m.start(), "access", m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LENGTH]
    found += [(m.start(), "hex", m.end()) for m in HEX.finditer(text)]
    if battery is not None:
        found += [(s, "random", e) for s, e in _random_spans(text, found, battery)]
    return sorted(found, key=lambda x: (x[0], KINDS.index(x[1])))


def joined(spans: list[tuple[int, str, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, kind, end in spans)


def redact(text: str | None, spans: list[tuple[int, str, int]], mark: str = "[secret]") -> str | None:
    """``text`` with each maximal covered stretch replaced by ``mark``."""
    out, at = [], 0
    for start, _, end in spans:
        if end <= at:
            continue
        if start >= at and not (out and start == at):
            out += [text[at:start], mark]
        at = end
    return text if not out else "".join(out) + text[at:]


def scan_table(
    documents: DataFrame, keep: dict[str, Column], text_col: str = "text", battery: Battery | None = Battery(), clean: bool = False
) -> DataFrame:
    """``keep``'s columns with the counts and spans of every text; with ``clean`` also ``redacted``.

    One task reads a text whole; null and empty texts have no spans. Ties of equal start are
    in the order of ``KINDS``; overlapping spans of different kinds all stay.
    """
    kept = documents.select(*[c.alias(n) for n, c in keep.items()], F.col(text_col).alias("_text"))
    new = "n_assign bigint, n_access bigint, n_hex bigint, n_random bigint, base_sha256 string, spans string"
    schema = extended(kept, new + ", redacted string" * clean, ("_text",))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [x.as_py() for x in batch.column(batch.num_columns - 1)]
            found = [scan(t, battery) for t in texts]
            counts = [pa.array([sum(x[1] == k for x in s) for s in found], pa.int64()) for k in KINDS]
            base = [joined([x for x in s if x[1] != "random"]) for s in found]
            columns = [
                *batch.columns[:-1],
                *counts,
                pa.array([hashlib.sha256(b.encode()).hexdigest() for b in base], pa.string()),
                pa.array([joined(s) for s in found], pa.string()),
            ]
            names = [*batch.schema.names[:-1], "n_assign", "n_access", "n_hex", "n_random", "base_sha256", "spans"]
            if clean:
                columns.append(pa.array([redact(t, s) for t, s in zip(texts, found)], pa.string()))
                names.append("redacted")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return kept.mapInArrow(run, schema)
