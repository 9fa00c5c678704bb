"""Periodic runs of words, found on a Re-Pair grammar of each text's repetitive stretches.

A run is a longest stretch of words with smallest period q (words q apart are equal) of at
least ``LEAST`` words and ``TIMES`` periods. For one text:

1. **Stretches.** In a run, each eight words after its first q stand q or fewer words
   further left as well, and there are at least 2q-7 of them in a row. Rows of eight-word
   starts whose last occurrence is that near are looked for, again inside what is left,
   until nothing changes; all other words are in no run. Hashes decide here, and two equal
   ones of different words can only add a stretch. This test loses no run.
2. **Grammar.** The words of the stretches are numbered and Re-Pair replaces the most
   frequent pair again and again. Of several most frequent pairs, those that share no
   symbol are replaced in one round, so copies of a long period fold into balanced trees
   in a logarithmic number of rounds. All stretches of a slice go through the rounds
   together; their symbols differ, so no pair joins two of them. What is left when no
   pair occurs twice is folded in halves.
3. **Boundaries.** Each rule X -> A B is taken once: for the periods at which the word
   beside the boundary recurs, the run through the boundary is followed to both sides,
   word by word, inside X.
4. **Places.** The runs of X are moved to every place where X stands. Each run of the text
   is found whole at the smallest symbol around it; parts of it, cut by a symbol's edge,
   lie inside it and go, like multiples of its period.

A text is handled by itself, in memory that grows with its length (about 15 times its
bytes). Nothing is shuffled or collected, and nothing depends on other texts.

Null and empty texts have no words and no runs. Every row gives a row, repeated rows and
rows without an id too; an empty table gives none. Other columns are ignored, whatever
their names.
"""

from __future__ import annotations

import hashlib
import itertools
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.arrays import BASE, mix

LEAST, TIMES = 24, 3
#: Words that are compared at once in the search for stretches.
GRAM = 8
#: Bytes of texts that go through the grammar together; one longer text goes alone.
SLICE_BYTES = 1_000_000
_U = np.uint64

Run = tuple[int, int, int]  # start, end, period


def stretches(ids: np.ndarray) -> list[tuple[int, int]]:
    """Disjoint ranges of words; every run lies in one of them."""
    n = len(ids) - GRAM + 1
    if len(ids) < LEAST:
        return []
    value = mix(ids.astype(_U) + _U(1))
    h = np.zeros(n, _U)
    for j in range(GRAM):
        h = h * _U(BASE) + value[j : j + n]
    order = np.argsort(h, kind="stable")
    repeated = h[order[1:]] == h[order[:-1]]
    at, back = order[1:][repeated], np.diff(order)[repeated]
    order = np.argsort(at)
    at, back = at[order], back[order]
    least = min(max(LEAST - q, (TIMES - 1) * q) - GRAM + 1 for q in range(1, LEAST))
    while len(at):
        edges = np.flatnonzero(np.diff(at) > 1) + 1
        sizes = np.diff(np.concatenate([[0], edges, [len(at)]]))
        # At least 2q - 7 starts: q is at most half of them and seven.
        widest = np.repeat((sizes + GRAM - 1) // (TIMES - 1), sizes)
        good = (back <= widest) & (np.repeat(sizes, sizes) >= least)
        if good.all():
            break
        at, back = at[good], back[good]
    if not len(at):
        return []
    edges = np.flatnonzero(np.diff(at) > 1) + 1
    firsts = at[np.concatenate([[0], edges])]
    lasts = at[np.concatenate([edges - 1, [len(at) - 1]])]
    out: list[tuple[int, int]] = []
    for first, last in zip(firsts.tolist(), lasts.tolist()):
        reach = (last - first + GRAM) // (TIMES - 1)
        start, end = max(0, first - reach), last + GRAM
        while out and out[-1][1] >= start:
            start = min(start, out.pop()[0])
        out.append((start, end))
    return out


class Grammar:
    """Rules by symbol: symbols below ``words`` are words, the others a pair each."""

    def __init__(self, words: int):
        self.words = words
        self.left: list[int] = []
        self.right: list[int] = []
        self.length: list[int] = []

    def size(self, symbol: int) -> int:
        return 1 if symbol < self.words else self.length[symbol - self.words]

    def rule(self, left: int, right: int) -> int:
        self.left.append(left)
        self.right.append(right)
        self.length.append(self.size(left) + self.size(right))
        return self.words + len(self.left) - 1


def _pairs(symbols: np.ndarray, part: np.ndarray) -> np.ndarray:
    """Where a pair begins that can be replaced: inside a part, and of three equal symbols
    in a row the first two only."""
    inside = part[1:] == part[:-1]
    equal = inside & (symbols[1:] == symbols[:-1])
    if equal.any():
        at = np.arange(len(equal))
        begins = np.maximum.accumulate(np.where(equal, -1, at))  # last place that is not equal
        inside &= ~equal | ((at - begins) % 2 == 1)
    return np.flatnonzero(inside)


def repair(parts: list[np.ndarray]) -> tuple[Grammar, list[int]]:
    """A grammar of all parts, whose symbols have to differ between parts, and a start
    symbol for each part."""
    symbols = np.concatenate(parts)
    part = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    grammar = Grammar(int(symbols.max()) + 1)
    done: dict[int, list[int]] = {}
    while len(symbols):
        n_symbols = grammar.words + len(grammar.left)
        at = _pairs(symbols, part)
        key = symbols[at] * n_symbols + symbols[at + 1]
        kinds, kind, count = np.unique(key, return_inverse=True, return_counts=True)
        of = np.zeros(len(kinds), np.int64)
        of[kind] = part[at]
        most = np.zeros(len(parts), np.int64)
        np.maximum.at(most, of, count)
        # Parts where no pair occurs twice are finished.
        over = most[part] < 2
        if over.any():
            for p in np.unique(part[over]).tolist():
                done[p] = symbols[part == p].tolist()
            symbols, part = symbols[~over], part[~over]
            continue
        chosen = count == most[of]
        left, right = kinds // n_symbols, kinds % n_symbols
        turn = (mix(kinds.astype(_U)) >> _U(1)).astype(np.int64)
        first = np.full(n_symbols, np.iinfo(np.int64).max)
        np.minimum.at(first, left[chosen], turn[chosen])
        np.minimum.at(first, right[chosen], turn[chosen])
        chosen &= (first[left] == turn) & (first[right] == turn)
        new = np.full(len(kinds), -1, np.int64)
        for k in np.flatnonzero(chosen).tolist():
            new[k] = grammar.rule(int(left[k]), int(right[k]))
        replaced = chosen[kind]
        symbols[at[replaced]] = new[kind[replaced]]
        kept = np.ones(len(symbols), bool)
        kept[at[replaced] + 1] = False
        symbols, part = symbols[kept], part[kept]
    starts = []
    for p in range(len(parts)):
        row = done.get(p, [])
        while len(row) > 1:
            folded = [grammar.rule(a, b) for a, b in zip(row[::2], row[1::2])]
            row = folded + row[len(folded) * 2 :]
        starts.append(row[0])
    return grammar, starts


def _equal_before(w: np.ndarray, i: int, j: int) -> int:
    """How many words end alike before i and before j, i < j."""
    n, step = 0, 32
    while n < i:
        most = min(step, i - n)
        differ = np.flatnonzero(w[i - n - most : i - n] != w[j - n - most : j - n])
        if len(differ):
            return n + most - 1 - int(differ[-1])
        n, step = n + most, step * 2
    return n


def _equal_from(w: np.ndarray, i: int, j: int) -> int:
    """How many words begin alike from i and from j on, i < j."""
    n, step, end = 0, 32, len(w) - j
    while n < end:
        most = min(step, end - n)
        differ = np.flatnonzero(w[i + n : i + n + most] != w[j + n : j + n + most])
        if len(differ):
            return n + int(differ[0])
        n, step = n + most, step * 2
    return n


def _shared(left: int, right: int, before: int, after: int, q: int) -> int:
    """Words that a run of period q through the boundary shares, at least, with one that
    reaches ``left`` and ``right`` words from it, in a row of ``before`` and ``after``."""
    reaches = max(0, TIMES * q - after), min(before, TIMES * q)
    return min(min(left, x) + min(right, TIMES * q - x) for x in reaches)


def through(w: np.ndarray, m: int) -> list[Run]:
    """The runs in ``w`` that hold words m-1 and m, each with its smallest period."""
    n = len(w)
    widest = n // TIMES
    # A run reaches more than a period to one side: there its word beside m recurs.
    after = np.flatnonzero(w[m + 1 : m + 1 + widest] == w[m]) + 1
    low = max(0, m - 1 - widest)
    before = m - 1 - low - np.flatnonzero(w[low : m - 1] == w[m - 1])
    found: list[Run] = []
    for q in np.union1d(after, before).tolist():
        if any(q % p == 0 and _shared(m - s, e - m, m, n - m, q) >= p + q for s, e, p in found):
            continue  # it would have period p and be the same run
        spans = set()
        if m + q <= n:  # words [m - back, m + ahead + q) repeat after q words
            spans.add((m - _equal_before(w, m, m + q), m + q + _equal_from(w, m, m + q)))
        if m - q >= 0:
            spans.add((m - q - _equal_before(w, m - q, m), m + _equal_from(w, m - q, m)))
        for s, e in spans:
            if s < m < e and e - s >= max(LEAST, TIMES * q):
                found.append((s, e, q))
    return found


def _places(w: np.ndarray, grammar: Grammar, start: int) -> list[Run]:
    """The runs of each symbol at all its places in ``w``."""
    known: dict[int, list[Run]] = {}
    found: list[Run] = []
    todo = [(start, 0)]
    while todo:
        symbol, at = todo.pop()
        size = grammar.size(symbol)
        if size < LEAST:
            continue
        left, right = grammar.left[symbol - grammar.words], grammar.right[symbol - grammar.words]
        m = grammar.size(left)
        if symbol not in known:
            known[symbol] = through(w[at : at + size], m)
        found += [(at + s, at + e, q) for s, e, q in known[symbol]]
        todo += [(left, at), (right, at + m)]
    return found


def merged(found: list[Run]) -> list[Run]:
    """Longest intervals only, each with its smallest period, by start and period."""
    period: dict[tuple[int, int], int] = {}
    for s, e, q in found:
        period[s, e] = min(q, period.get((s, e), q))
    runs, end = [], {}
    for (s, e), q in sorted(period.items(), key=lambda x: (x[1], x[0][0], -x[0][1])):
        if e > end.get(q, -1):
            end[q] = e
            runs.append((s, e, q))
    return sorted(runs, key=lambda r: (r[0], r[2]))


def runs_of(texts: list[np.ndarray]) -> list[list[Run]]:
    """The runs of each text, given as word numbers from 0."""
    parts, owners, below = [], [], 0
    for i, ids in enumerate(texts):
        for start, end in stretches(ids):
            names, own = np.unique(ids[start:end], return_inverse=True)
            parts.append(own.astype(np.int64) + below)
            owners.append((i, start))
            below += len(names)
    found: list[list[Run]] = [[] for _ in texts]
    if parts:
        words = [p.copy() for p in parts]
        grammar, starts = repair(parts)
        for w, symbol, (i, start) in zip(words, starts, owners):
            found[i] += [(start + s, start + e, q) for s, e, q in merged(_places(w, grammar, symbol))]
    return [sorted(f, key=lambda r: (r[0], r[2])) for f in found]


def numbered(words: list[bytes]) -> np.ndarray:
    """Equal words get equal numbers."""
    table: dict[bytes, int] = {}
    return np.fromiter(map(table.setdefault, words, itertools.count()), np.int64, len(words))


def planted(doc_id: int | None, n: int) -> np.ndarray | None:
    """For every tenth document by hash: which original word each word becomes."""
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    at = np.arange(n)
    at[a:] = a + (at[a:] - a) % p
    return at


def _row(words: list[bytes], runs: list[Run]) -> tuple:
    covered = np.zeros(len(words) + 1, np.int64)
    best = None
    for s, e, q in runs:
        covered[s + q] += 1
        covered[e] -= 1
        if best is None or (e - s) * best[2] > (best[1] - best[0]) * q:
            best = s, e, q
    if runs:
        kept = np.cumsum(covered[:-1]) == 0
        words = list(itertools.compress(words, kept.tolist()))
    listed = "".join(f"{s},{e - s},{q}\n" for s, e, q in runs).encode()
    s, e, q = best or (None, None, None)
    return (
        len(runs),
        s,
        best and e - s,
        q,
        best and 1000 * (e - s) // q,
        hashlib.sha256(listed).hexdigest(),
        hashlib.sha256(b" ".join(words)).hexdigest(),
        b" ".join(words),
    )


FOUND = (
    "n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, "
    "runs_sha256 string, collapsed_sha256 string"
)


def periodic_runs(docs: DataFrame, plant: bool = False, collapsed: bool = False) -> DataFrame:
    """doc_id and, per row of ``docs``, the number of runs, the run of the greatest exact
    length per period (ties: least start, then period), and digests of all runs and of the
    words that are left when repeats go; with ``collapsed`` those words too.

    ``plant`` first makes every tenth text periodic from some word on.
    """
    fields = FOUND + (", collapsed string" if collapsed else "")
    names = ["doc_id", *(f.split()[0] for f in fields.split(", "))]
    kinds = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.string()] * collapsed

    def rows(batches):
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).cast(pa.large_binary())
            first = 0
            while first < batch.num_rows:
                held, numbers, n_bytes = [], [], 0
                last = first
                while last < batch.num_rows and n_bytes < SLICE_BYTES:
                    text = texts[last].as_py() or b""
                    words = text.split()  # at the six ASCII spaces
                    own = planted(ids[last].as_py(), len(words)) if plant else None
                    if own is not None:
                        words = [words[i] for i in own.tolist()]
                    held.append(words)
                    numbers.append(numbered(words))
                    n_bytes += len(text)
                    last += 1
                found = [_row(w, r) for w, r in zip(held, runs_of(numbers))]
                columns = list(zip(*found))[: len(kinds)]
                yield pa.record_batch(
                    [ids.slice(first, last - first), *(pa.array(c, k) for c, k in zip(columns, kinds))], names
                )
                first = last

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(rows, f"doc_id bigint, {fields}")
