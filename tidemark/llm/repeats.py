"""Byte strings that stand in more than one place, by backward extension on a
Burrows-Wheeler transform.

Every string of ``least`` bytes has an anchor: the ``KEY``-byte string inside it of the
smallest hash (the last of equal ones). Equal strings have equal anchors in equal places,
so strings are only compared under their anchor's hash, and that spreads the corpus over
all tasks by a shuffle of hashes alone. The strings that share one anchor are a stretch of
text, the anchor's context:

1. Per anchor and context: how often. Contexts equal as a whole (``least`` bytes and more, by two
   64-bit hashes) are repeated throughout; anchors of one place only are repeated nowhere.
2. Where an anchor has several different contexts, one copy of each goes on. A task joins
   contexts to a text with ends between them, sorts its suffixes, and finds the borders of
   common prefixes by increasing length: each interval of suffixes is extended to the left
   by every symbol through the transform's mapping, all intervals of a length at a time;
   an interval whose right border is new has a common prefix of just that length. It stops
   at ``least``: what is not parted by then shares ``least`` bytes.
3. Anchors of more than ``HOT`` contexts are not given to one task: their strings are
   counted by hash, one row each, which finds the same strings.

Documents hold their places in bytes of UTF-8; matches never cross documents. Equal
contexts in one slice of texts are combined before the first shuffle, so a passage in a
third of all texts, or a text that repeats itself, sends few rows.

Null text counts as empty and has no repeats. Rows that repeat an id are separate places,
so equal ones are repeats of each other. Every row gives a row. An empty table gives no
rows. Columns of any name are carried.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.arrays import flat_ranges, groups, mix, utf8, window_hashes
from tidemark.llm.common import document_columns, other_columns, stored

LEAST = 200
KEY = 64
SLICE = 250_000
#: Bytes of context that one transform covers, and contexts of one anchor that may be in it.
BATCH = 125_000
HOT = 4096
#: Common prefixes up to this length come from the first rounds of sorting.
SEED = 28
_U = np.uint64


def contexts(data: np.ndarray, offsets: np.ndarray, least: int, key: int):
    """(text, first, last + 1, anchor hash, context hash) of the contexts of all texts."""
    n, width = len(data), least - key + 1
    none = np.zeros(0, np.int64)
    if n < least:
        return none, none, none, none.view(_U), none.view(_U)
    sums, back = window_hashes(data, 4)
    hashes = mix((sums[key:] - sums[:-key]) * back[: n - key + 1])
    # Hash above, place below, so that the least is the last of equal hashes.
    low = _U((1 << n.bit_length()) - 1)
    least_of = (hashes & ~low) | (low - np.arange(len(hashes), dtype=_U))
    reach = 1
    while 2 * reach <= width:
        least_of = np.minimum(least_of[: len(least_of) - reach], least_of[reach:])
        reach *= 2
    rest = width - reach
    least_of = np.minimum(least_of[: len(least_of) - rest], least_of[rest:])
    anchor = (low - (least_of & low)).astype(np.int64)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    whole = np.flatnonzero(text[: len(anchor)] == text[least - 1 :])
    anchor, owner = anchor[whole], text[whole]
    head = np.flatnonzero(np.append(True, (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1]))[: len(anchor)])
    first = whole[head]
    last = whole[np.append(head[1:], len(anchor))[: len(head)] - 1] + least
    anchor = anchor[head]
    sums, back = window_hashes(data, 5)
    own = (sums[last] - sums[first]) * back[first]
    own = mix(mix(own) + (anchor - first).astype(_U) * _U(1 << 32) + (last - first).astype(_U))
    return owner[head], first, last, hashes[anchor], own


def merged(spans: np.ndarray) -> np.ndarray:
    """Maximal runs of (start, end) rows; runs that touch are one."""
    if len(spans) < 2:
        return spans
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    head = np.flatnonzero(np.append(True, spans[1:, 0] > reach[:-1]))
    return np.stack([spans[head, 0], reach[np.append(head[1:], len(spans)) - 1]], 1)


def _span_bytes(spans: np.ndarray) -> bytes:
    return spans.astype("<i8").tobytes()


def _spans(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, "<i8").reshape(-1, 2)


ROWS = "f bigint, h bigint, n bigint, d bigint, t int, lo bigint, hi bigint, spans binary"


def _context_rows(least: int, key: int):
    """One row per different context of a slice, and one per text that repeats in the slice."""

    def rows(batches):
        for batch in batches:
            data, offsets = utf8(batch.column(2))
            d, t = batch.column(0), batch.column(1)
            for begin, end in groups(offsets, SLICE):
                own = offsets[begin : end + 1]
                text, first, last, f, h = contexts(data[own[0] : own[-1]], own - own[0], least, key)
                if not len(text):
                    continue
                order = np.lexsort((h, f))
                fs, hs = f[order], h[order]
                head = np.flatnonzero(np.append(True, (fs[1:] != fs[:-1]) | (hs[1:] != hs[:-1])))
                n = np.diff(np.append(head, len(order)))
                one = order[head]
                base = (own - own[0])[text]
                again = order[np.repeat(n > 1, n)]
                spans = np.stack([first - base, last - base], 1)
                yield _batch(d, t, begin + text[one], spans[one], f[one], h[one], n)
                if len(again):
                    again = np.sort(again)
                    bounds = np.flatnonzero(np.append(True, text[again][1:] != text[again][:-1]))
                    raws = [_span_bytes(merged(x)) for x in np.split(spans[again], bounds[1:])]
                    at = pa.array(begin + text[again][bounds])
                    m = len(raws)
                    yield pa.record_batch(
                        [pa.nulls(m, pa.int64())] * 3
                        + [d.take(at), t.take(at)]
                        + [pa.nulls(m, pa.int64())] * 2
                        + [pa.array(raws, pa.binary())],
                        _NAMES,
                    )

    return rows


_NAMES = [c.split()[0] for c in ROWS.split(", ")]


def _batch(d, t, at, spans, f, h, n) -> pa.RecordBatch:
    return pa.record_batch(
        [
            pa.array(f.view(np.int64)),
            pa.array(h.view(np.int64)),
            pa.array(n.astype(np.int64)),
            d.take(pa.array(at)),
            t.take(pa.array(at)),
            pa.array(spans[:, 0]),
            pa.array(spans[:, 1]),
            pa.nulls(len(at), pa.binary()),
        ],
        _NAMES,
    )


def _ranked(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the keys, and each key's dense rank from 0."""
    order = np.argsort(keys)
    ordered = keys[order]
    ranks = np.empty(len(keys), np.int64)
    ranks[order] = np.cumsum(np.append(False, ordered[1:] != ordered[:-1]))
    return order, ranks


def suffix_order(symbols: np.ndarray, ends: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes sorted by their first ``depth`` symbols or more, and the ranks by ``SEED``.

    ``symbols``: 0 behind each text, else byte + 1. ``ends``: place of the 0 behind each place.
    A suffix ends with its text's 0. Twice as many symbols count in each round.
    """
    n = len(symbols)
    padded = np.append(symbols, np.zeros(7, np.int64)).astype(np.int64)
    keys = np.zeros(n, np.int64)
    live = np.ones(n, bool)
    for j in range(7):
        now = np.where(live, padded[j : j + n], 0)
        keys = keys << 9 | now
        live &= now > 0
    order, ranks = _ranked(keys)
    reach, seed = 7, None
    while reach < depth:
        if reach == SEED:
            seed = ranks
        at = np.arange(n) + reach
        behind = np.where(at <= ends, np.append(ranks, np.zeros(reach, np.int64))[at] + 1, 0)
        order, ranks = _ranked(ranks * (n + 1) + behind)
        reach *= 2
    return order, ranks if seed is None else seed


def repeat_runs(symbols: np.ndarray, ends: np.ndarray, starts: np.ndarray, least: int):
    """Suffixes in order, and where a new run begins of suffixes that share ``least`` symbols.

    Breadth first: from the intervals of ``SEED`` symbols on, all intervals of one length
    are extended to the left by one symbol. The mapping of the transform leads from a
    suffix to the one that starts a place earlier.
    """
    n = len(symbols)
    order, seed = suffix_order(symbols, ends, least)
    place = np.empty(n, np.int32)
    place[order] = np.arange(n, dtype=np.int32)
    earlier = place[order - 1]
    earlier[np.isin(order, starts)] = -1  # no suffix starts before its text
    first = symbols[order]
    seeds = seed[order]
    border = np.append(True, seeds[1:] != seeds[:-1])
    border = np.append(border, True)
    lo = np.flatnonzero(border[:-1])
    hi = np.append(lo[1:], n)
    for _ in range(SEED, least):
        if not len(lo):
            break
        rows = earlier[flat_ranges(lo, hi - lo)]
        owner = np.repeat(np.arange(len(lo), dtype=np.int32), hi - lo)
        seen = np.flatnonzero(rows >= 0)
        rows, owner = rows[seen], owner[seen]
        # An interval's rows lie side by side; order them as they stand.
        sort = np.argsort(rows)
        rows, owner = rows[sort], owner[sort]
        new = np.append(
            True,
            (rows[1:] != rows[:-1] + 1) | (owner[1:] != owner[:-1]) | (first[rows[1:]] != first[rows[:-1]]),
        )[: len(rows)]
        head = np.flatnonzero(new)
        right = rows[np.append(head[1:], len(rows))[: len(head)] - 1] + 1
        fresh = ~border[right]
        border[right[fresh]] = True
        lo, hi = rows[head[fresh]].astype(np.int64), right[fresh].astype(np.int64)
    return order, border[:-1]


def repeated_in(texts: list[bytes], places: np.ndarray, least: int) -> list[np.ndarray]:
    """Runs (start, end) of each text covered by strings of ``least`` bytes found at another place.

    ``places``: number of the first byte of each text; texts cut from one document may overlap.
    """
    lengths = np.array([len(x) for x in texts], np.int64)
    starts = np.cumsum(lengths + 1) - lengths - 1
    raw = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8)
    symbols = raw.astype(np.int64) + 1
    symbols[starts + lengths] = 0
    text = np.repeat(np.arange(len(texts)), lengths + 1)
    ends = (starts + lengths)[text]
    order, border = repeat_runs(symbols, ends, starts, least)
    head = np.flatnonzero(border)
    size = np.diff(np.append(head, len(order)))
    several = np.repeat(size > 1, size)
    found = order[several]
    if not len(found):
        return [np.zeros((0, 2), np.int64)] * len(texts)
    size = size[size > 1]
    head = np.cumsum(size) - size
    where = places[text[found]] + (found - starts[text[found]])
    differ = np.minimum.reduceat(where, head) != np.maximum.reduceat(where, head)
    found = found[np.repeat(differ, size) & (ends[found] - found >= least)]
    found = np.sort(found)
    owner = text[found]
    bounds = np.searchsorted(owner, np.arange(len(texts) + 1))
    out = []
    for i in range(len(texts)):
        at = found[bounds[i] : bounds[i + 1]] - starts[i]
        if len(at):
            cut = np.flatnonzero(np.append(True, at[1:] > at[:-1] + least))
            out.append(np.stack([at[cut], at[np.append(cut[1:], len(at)) - 1] + least], 1))
        else:
            out.append(np.zeros((0, 2), np.int64))
    return out


def _numbers(d: np.ndarray, t: np.ndarray, lo: np.ndarray) -> np.ndarray:
    """Numbers of places: those of one document are consecutive, and documents far apart."""
    own = mix(mix(d.astype(np.int64).view(_U)) + t.astype(np.int64).view(_U))
    return ((own >> _U(1)).astype(np.int64) & ~np.int64((1 << 20) - 1)) + lo


SPANS = "d bigint, t int, spans binary"


def _span_batch(d, t, lo, found) -> pa.RecordBatch:
    keep = [i for i, x in enumerate(found) if len(x)]
    raws = [_span_bytes(found[i] + lo[i]) for i in keep]
    return pa.record_batch(
        [pa.array(d[keep], pa.int64()), pa.array(t[keep], pa.int32()), pa.array(raws, pa.binary())],
        ["d", "t", "spans"],
    )


def _transformed(least: int):
    """Repeated runs of the contexts of whole anchors, as many anchors at a time as ``BATCH`` takes."""

    def rows(batches):
        held, own, size, own_size = [], [], 0, 0  # whole anchors, and the one that is being read

        def flush(rows):
            f, d, t, lo, raw = zip(*rows)
            d, t, lo = np.array(d, np.int64), np.array(t, np.int32), np.array(lo, np.int64)
            return _span_batch(d, t, lo, repeated_in(list(raw), _numbers(d, t, lo), least))

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("f", "d", "t", "lo", "bytes"))):
                if own and row[0] != own[0][0]:
                    if held and size + own_size > BATCH:
                        yield flush(held)
                        held, size = [], 0
                    held, size = held + own, size + own_size
                    own, own_size = [], 0
                own.append(row)
                own_size += len(row[4])
        if held and size + own_size > BATCH:
            yield flush(held)
            held = []
        if held or own:
            yield flush(held + own)

    return rows


def _counted_strings(least: int):
    """A row per string of the contexts of anchors with too many of them."""

    def rows(batches):
        for batch in batches:
            for d, t, lo, raw in zip(*(batch.column(c).to_pylist() for c in ("d", "t", "lo", "bytes"))):
                data = np.frombuffer(raw, np.uint8)
                halves = []
                for seed in (6, 7):
                    sums, back = window_hashes(data, seed)
                    halves.append(mix((sums[least:] - sums[:-least]) * back[: len(data) - least + 1]))
                n = len(halves[0])
                at = lo + np.arange(n)
                yield pa.record_batch(
                    [
                        pa.array(halves[0].view(np.int64)),
                        pa.array(halves[1].view(np.int64)),
                        pa.array([d] * n, pa.int64()),
                        pa.array([t] * n, pa.int32()),
                        pa.array(at, pa.int64()),
                        pa.array(_numbers(np.full(n, d), np.full(n, t), at)),
                    ],
                    ["x", "y", "d", "t", "at", "place"],
                )

    return rows


def _hot_spans(rows: DataFrame, least: int) -> DataFrame:
    strings = rows.mapInArrow(
        _counted_strings(least), "x bigint, y bigint, d bigint, t int, at bigint, place bigint"
    )
    strings = stored(strings, "repeats-strings")
    several = strings.groupBy("x", "y").agg(F.min("place").alias("p"), F.max("place").alias("q"))
    found = strings.join(several.where("p <> q").select("x", "y"), ["x", "y"], "left_semi")

    def spans(batches):
        for batch in batches:
            at = batch.column(2).to_numpy()
            raws = [_span_bytes(np.array([[a, a + least]])) for a in at.tolist()]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(raws, pa.binary())], ["d", "t", "spans"])

    return found.select("d", "t", "at").mapInArrow(spans, SPANS)


def _keyed(docs: DataFrame) -> DataFrame:
    """doc (all columns but the text), d and t (which row), text."""
    return docs.select(
        other_columns(docs),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("d"),
        F.hash("text").alias("t"),
        F.coalesce("text", F.lit("")).alias("text"),
    )


def remove_spans(data: bytes, spans: np.ndarray) -> bytes:
    kept, at = [], 0
    for start, end in spans.tolist():
        kept.append(data[at:start])
        at = end
    kept.append(data[at:])
    return b"".join(kept)


def whole_characters(data: bytes, spans: np.ndarray) -> np.ndarray:
    """Spans without characters of which they hold only a part."""
    out = []
    for start, end in spans.tolist():
        while start < end and data[start] & 0xC0 == 0x80:
            start += 1
        while end > start and end < len(data) and data[end] & 0xC0 == 0x80:
            end -= 1
        if start < end:
            out.append((start, end))
    return np.array(out, np.int64).reshape(-1, 2)


def digest(data: bytes, spans: np.ndarray) -> tuple:
    removed = int((spans[:, 1] - spans[:, 0]).sum())
    return len(data), removed, len(spans), hashlib.sha256(remove_spans(data, spans)).hexdigest()


def cleaned(data: bytes, spans: np.ndarray) -> tuple:
    return (remove_spans(data, whole_characters(data, spans)).decode(),)


DIGEST = T.StructType(
    [
        T.StructField("n_bytes", T.LongType()),
        T.StructField("n_removed", T.LongType()),
        T.StructField("n_spans", T.LongType()),
        T.StructField("kept_sha256", T.StringType()),
    ]
)
TEXT = T.StructType([T.StructField("text", T.StringType())])


def _arrow(kind: T.DataType) -> pa.DataType:
    return pa.int64() if isinstance(kind, T.LongType) else pa.string()


def apply_repeats(docs: DataFrame, finish, result: T.StructType, least: int = LEAST) -> DataFrame:
    """(doc, the columns of ``result``): ``finish(bytes, runs)`` for every row.

    Texts are shuffled once, to meet what is known of them; those with contexts in a
    transform wait in a stored table.
    """
    texts = _keyed(docs)
    rows = stored(
        texts.select("d", "t", "text").mapInArrow(_context_rows(least, KEY), ROWS), "repeats-contexts"
    )
    found = rows.where("f IS NOT NULL")
    per_anchor = (
        found.groupBy("f")
        .agg(F.sum("n").alias("n_all"), (F.min("h") != F.max("h")).alias("mixed"))
        .where("n_all > 1")
        .select("f", "mixed")
    )
    again = stored(found.drop("spans").join(per_anchor, "f"), "repeats-anchors")
    which = F.xxhash64("d", "t", "lo")
    per_context = (
        again.where("mixed").groupBy("f", "h").agg(F.sum("n").alias("n_all"), F.min(which).alias("one"))
    )
    per_context = stored(per_context, "repeats-counts")
    hot = per_context.groupBy("f").count().where(F.col("count") > HOT).select("f")
    labelled = again.join(per_context, ["f", "h"], "left").select(
        "d",
        "t",
        F.struct(
            "f",
            "lo",
            "hi",
            (~F.col("mixed") | (F.col("n_all") > 1)).alias("all"),
            (F.col("mixed") & (which == F.col("one"))).alias("sent"),
        ).alias("context"),
        F.lit(None).cast("binary").alias("spans"),
    )
    known = rows.where("f IS NULL").select(
        "d", "t", F.lit(None).cast(labelled.schema["context"].dataType).alias("context"), "spans"
    )
    per_text = (
        labelled.unionByName(known)
        .groupBy("d", "t")
        .agg(F.collect_list("context").alias("contexts"), F.collect_list("spans").alias("spans"))
    )  # contexts of one text: no more than it has places
    first = stored(
        texts.join(per_text, ["d", "t"], "left")
        .select("doc", "d", "t", "text", "contexts", "spans")
        .mapInArrow(_first_pass(finish, result), _first_schema(texts, result)),
        "repeats-texts",
    )
    sent = first.where("f IS NOT NULL").select("f", "d", "t", "lo", "bytes")
    runs = sent.join(hot, "f", "left_anti").repartition("f").sortWithinPartitions("f").mapInArrow(
        _transformed(least), SPANS
    )
    runs = stored(runs, "repeats-runs")
    if not hot.isEmpty():
        runs = runs.unionByName(_hot_spans(sent.join(hot, "f", "left_semi"), least))
    runs = runs.groupBy("d", "t").agg(F.collect_list("spans").alias("more"))
    waiting = first.where("waits").select("doc", "d", "t", "text", "spans")
    late = (
        waiting.join(runs, ["d", "t"], "left")
        .select("doc", "text", "spans", "more")
        .mapInArrow(_last_pass(finish, result), T.StructType([first.schema["doc"], *result.fields]))
    )
    done = first.where("done").select("doc", F.col("result.*"))
    return done.unionByName(late)


def _first_schema(texts: DataFrame, result: T.StructType) -> T.StructType:
    return T.StructType(
        [
            T.StructField("doc", texts.schema["doc"].dataType),
            T.StructField("d", T.LongType()),
            T.StructField("t", T.IntegerType()),
            T.StructField("text", T.StringType()),
            T.StructField("spans", T.BinaryType()),
            T.StructField("done", T.BooleanType()),
            T.StructField("waits", T.BooleanType()),
            T.StructField("result", result),
            T.StructField("f", T.LongType()),
            T.StructField("lo", T.LongType()),
            T.StructField("bytes", T.BinaryType()),
        ]
    )


def _first_pass(finish, result: T.StructType):
    """Results of texts that need no transform; the others, and the contexts they send."""
    names = ["doc", "d", "t", "text", "spans", "done", "waits", "result", "f", "lo", "bytes"]
    fields = [(f.name, _arrow(f.dataType)) for f in result.fields]

    def rows(batches):
        for batch in batches:
            n = batch.num_rows
            texts = batch.column("text").to_pylist()
            all_contexts, all_spans = batch.column("contexts").to_pylist(), batch.column("spans").to_pylist()
            sent, spans_of, waits, results = [], [], [], []
            for i, (text, own, raws) in enumerate(zip(texts, all_contexts, all_spans)):
                data = text.encode()
                known = [_spans(x) for x in raws or ()]
                known.append(np.array([(c["lo"], c["hi"]) for c in own or () if c["all"]], np.int64).reshape(-1, 2))
                spans = merged(np.concatenate(known))
                mine = [(i, c["f"], c["lo"], data[c["lo"] : c["hi"]]) for c in own or () if c["sent"]]
                sent += mine
                waits.append(bool(mine))
                spans_of.append(_span_bytes(spans) if mine else None)
                results.append(None if mine else dict(zip((k for k, _ in fields), finish(data, spans))))
            nulls = [pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary())]
            yield pa.record_batch(
                [
                    batch.column("doc"),
                    batch.column("d"),
                    batch.column("t"),
                    pa.array([x if w else None for x, w in zip(texts, waits)], pa.string()),
                    pa.array(spans_of, pa.binary()),
                    pa.array([not w for w in waits]),
                    pa.array(waits),
                    pa.array(results, pa.struct(fields)),
                    *nulls,
                ],
                names,
            )
            if sent:
                at = pa.array([x[0] for x in sent])
                m = len(sent)
                yield pa.record_batch(
                    [
                        pa.nulls(m, batch.column("doc").type),
                        batch.column("d").take(at),
                        batch.column("t").take(at),
                        pa.nulls(m, pa.string()),
                        pa.nulls(m, pa.binary()),
                        pa.array([False] * m),
                        pa.array([False] * m),
                        pa.nulls(m, pa.struct(fields)),
                        pa.array([x[1] for x in sent], pa.int64()),
                        pa.array([x[2] for x in sent], pa.int64()),
                        pa.array([x[3] for x in sent], pa.binary()),
                    ],
                    names,
                )

    return rows


def _last_pass(finish, result: T.StructType):
    fields = [(f.name, _arrow(f.dataType)) for f in result.fields]

    def rows(batches):
        for batch in batches:
            results = []
            for text, raw, more in zip(*(batch.column(c).to_pylist() for c in ("text", "spans", "more"))):
                spans = merged(np.concatenate([_spans(raw), *(_spans(x) for x in more or ())]))
                results.append(finish(text.encode(), spans))
            columns = zip(*results) if results else [[] for _ in fields]
            yield pa.record_batch(
                [batch.column("doc"), *(pa.array(list(c), k) for c, (_, k) in zip(columns, fields))],
                ["doc", *(name for name, _ in fields)],
            )

    return rows


def repeat_digests(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row."""
    out = apply_repeats(docs.select("doc_id", "text"), digest, DIGEST, least)
    return out.select("doc.doc_id", *[f.name for f in DIGEST.fields])


def without_repeats(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """The rows with repeated runs taken out of the text, whole characters only."""
    out = apply_repeats(docs, cleaned, TEXT, least)
    return out.select(*document_columns(docs.columns))
