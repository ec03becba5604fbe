"""Best-fit packing with large-item matching.

Documents are tokenised once into pieces of at most ``capacity`` tokens.  What
is packed is the histogram of piece lengths, at most ``capacity`` numbers
whatever the table's size: pieces longer than a third of the capacity fit at
most twice into a sequence and are matched greedily, the longest with the
longest that still fits beside it; smaller pieces then go, longest first, into
the smallest remaining gap that holds them.  The resulting plan says, for every
length, which ranks of its pieces go to which kind of sequence, and each piece
finds its place from its rank among the pieces of its length.  Ranks are dealt
by task counts, so neither a frequent length nor the table is sorted or gathered.

Defined cases: a null or empty text is one piece that holds the end token alone;
rows that share an id are packed as documents of their own; an empty table gives
an empty result; other columns are never read.
"""

from __future__ import annotations

import functools
import json
import sys
import zlib
from array import array
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidalrec.llm.common import Scratch, load


@dataclass(frozen=True)
class Packing:
    capacity: int = 1024
    tokenizer: str | None = None  # path of a tokenizers file; None: public byte_bpe_50k.json
    end_id: int = 2
    cache_words: int = 300_000      # chunks kept by a worker; only memory and speed depend on it


class ChunkCachingTokenizer:
    """Little-endian uint32 token ids of texts, as the plain call of the tokenizer gives them.

    A byte-level tokenizer that splits by its own pattern never merges across the places
    found by ``_starts``, where a pretoken begins whatever stands around it.  So a group of
    texts is cut there, Arrow numbers its distinct chunks, frequent ones are looked up, and
    only others go through ``tokenizers``; ids are laid out by the numbers.
    Texts that hold an added token, and tokenizers of another kind, take the plain call.
    """

    def __init__(self, path: str, most: int):
        from tokenizers import Tokenizer
        self._tok = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            told = json.load(f)
        kind = told.get("pre_tokenizer") or {}
        self._cuts = (not told.get("normalizer") and kind.get("type") == "ByteLevel" and kind.get("use_regex", True)
                      and not kind.get("add_prefix_space"))
        self._added = [t["content"] for t in told.get("added_tokens", [])]
        # when ``_young`` is full it becomes ``_old``, from which what is met again returns
        self._young: dict[bytes, bytes] = {}
        self._old: dict[bytes, bytes] = {}
        self._most = max(1, most // 2)

    def _ids(self, texts: list[str]) -> list[bytes]:
        """Ids of each text; what ``tokenizers`` returns is far larger than they are, so only some of it is held at once."""
        out: list[bytes] = []
        for at in range(0, len(texts), _TOKENIZED_AT_ONCE):
            out += [_little_endian(e.ids) for e in self._tok.encode_batch_fast(
                texts[at:at + _TOKENIZED_AT_ONCE], add_special_tokens=False)]
        return out

    def _looked_up(self, chunks: list[bytes]) -> list[bytes]:
        """The ids of distinct chunks."""
        if len(self._young) > self._most:
            self._young, self._old = {}, self._young
        known, old = self._young, self._old
        out = list(map(known.get, chunks))
        missing = []
        for at in [at for at, ids in enumerate(out) if ids is None]:
            w = chunks[at]
            ids = old.get(w)
            if ids is None:
                missing.append(at)
            else:
                out[at] = known[w] = ids
        for at, ids in zip(missing, self._ids([chunks[at].decode() for at in missing])):
            out[at] = ids
            if len(chunks[at]) <= 64:  # longer ones, such as texts without spaces, are not worth their memory
                known[chunks[at]] = ids
        return out

    def encode(self, texts: pa.Array) -> list[bytes]:
        """The ids of each text (large_binary, no nulls); what is new in any of them goes through the tokenizer at once."""
        plain = np.full(len(texts), not self._cuts)
        for token in self._added:
            plain |= pc.match_substring(texts, token.encode()).to_numpy(zero_copy_only=False)
        whole = {at: self._ids([texts[at].as_py().decode()])[0] for at in np.flatnonzero(plain).tolist()}
        cut = texts.filter(pa.array(~plain)) if whole else texts
        if not len(cut):
            return [whole[at] for at in range(len(texts))]
        _, offsets, data = cut.buffers()
        ends = np.frombuffer(offsets, np.int64)[cut.offset:cut.offset + len(cut) + 1]
        raw = np.frombuffer(data, np.uint8)[ends[0]:ends[-1]] if data else np.empty(0, np.uint8)
        ends = ends - ends[0]
        at = _starts(raw, ends)
        numbered = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(at), [None, pa.py_buffer(np.append(at, len(raw))), pa.py_buffer(raw)]).dictionary_encode()
        chunk = numbered.indices.to_numpy()
        blobs = self._looked_up(numbered.dictionary.to_numpy(zero_copy_only=False).tolist())
        flat = np.frombuffer(b"".join(blobs), "<u4")
        sizes = np.fromiter(map(len, blobs), np.int64, len(blobs)) // 4
        size = sizes[chunk]
        stops = np.concatenate([[0], np.cumsum(size)])
        ids = flat[np.repeat((np.cumsum(sizes) - sizes)[chunk] - stops[:-1], size) + np.arange(stops[-1])].tobytes()
        bounds = (4 * stops[np.searchsorted(at, ends)]).tolist()
        told = iter([ids[a:b] for a, b in zip(bounds, bounds[1:])])
        return [whole[n] if n in whole else next(told) for n in range(len(texts))]


_TOKENIZED_AT_ONCE = 20_000  # chunks
_VISIBLE = np.zeros(256, bool)
_VISIBLE[0x21:0x7F] = True
_OPENS = _VISIBLE.copy()    # bytes that begin a visible character, if not one of _BLANK
_OPENS[0xC2:0xF5] = True
_NAME = np.zeros(256, bool)
_NAME[[*b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"]] = True
_MARK = _VISIBLE & ~_NAME
_MARK[ord("'")] = False     # may open a contraction
_BLANK = ((0xC2, 0x85), (0xC2, 0xA0), (0xE1, 0x9A), (0xE2, 0x80), (0xE2, 0x81), (0xE3, 0x80))  # first bytes of all other spaces


def _starts(raw: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Where the chunks of texts begin, given their bytes one after the other and their bounds.

    Before a space that a visible character follows; before a mark after a letter or digit; around a
    single line break between visible characters.  The tokenizer's pattern opens a pretoken at each.
    """
    n = len(raw)
    if not n:
        return np.empty(0, np.int64)
    visible = _VISIBLE[raw]
    cut = np.zeros(n, bool)
    space, opens = raw[:-1] == 0x20, _OPENS[raw[1:]]
    for first, second in _BLANK:
        opens[:-1] &= ~((raw[1:-1] == first) & (raw[2:] == second))
    cut[:-1] = space & opens
    cut[ends[1:][ends[1:] > 0] - 1] = False     # what follows is another text
    cut[1:] |= _NAME[raw[:-1]] & _MARK[raw[1:]]
    broken = (raw[1:] == 0x0A) & visible[:-1]
    cut[1:] |= broken
    cut[2:] |= broken[:-1] & visible[2:]
    cut[ends[:-1][ends[:-1] < n]] = True
    return np.flatnonzero(cut)


def _little_endian(ids: list[int]) -> bytes:
    out = array("I", ids)  # of four bytes wherever Spark runs
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


def _encoded(tok: ChunkCachingTokenizer, texts: pa.Array, chars: int = 1 << 21) -> Iterator[bytes]:
    """The ids of each text, taken together up to about ``chars`` bytes; a longer one alone or with those before it."""
    texts = pc.fill_null(texts, "").cast(pa.large_binary())
    group = np.cumsum(pc.binary_length(texts).to_numpy()) // chars
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(texts)]
    for a, b in zip(cuts, cuts[1:]):
        yield from tok.encode(texts.slice(a, b - a))


@functools.lru_cache(maxsize=4)
def tokenizer_of(path: str, most: int) -> ChunkCachingTokenizer:
    """A worker's tokenizer and cache, kept from task to task."""
    return ChunkCachingTokenizer(path, most)


def pieces(docs: DataFrame, p: Packing, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): a longer document's first piece takes the remainder."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        path = p.tokenizer
        if path is None:
            import public_tokenizers
            path = public_tokenizers.path("byte_bpe_50k.json")
        tok = tokenizer_of(path, p.cache_words)
        end = np.asarray([p.end_id], "<u4").tobytes()
        for batch in batches:
            rows: list[tuple] = []
            which: list[int] = []
            for r, ids in enumerate(_encoded(tok, batch.column(1))):
                ids += end
                n = len(ids) // 4
                at, k = 0, 0
                while at < n:
                    size = (n - at) % p.capacity or min(p.capacity, n - at)
                    rows.append((k, at, size, zlib.crc32(ids[4 * at:4 * (at + size)])))
                    which.append(r)
                    at, k = at + size, k + 1
            ids_col = batch.column(0).take(pa.array(which, pa.int32()))
            cols = list(zip(*rows)) if rows else [(), (), (), ()]
            yield pa.RecordBatch.from_arrays(
                [ids_col, pa.array(cols[0], pa.int32()), *(pa.array(c, pa.int64()) for c in cols[1:])],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("t")).mapInArrow(
        run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def plan(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Kinds of sequence: (lengths inside, how many such sequences).

    Works on whole classes of equal lengths and equal gaps, so its time depends
    on the capacity, not on the number of pieces.
    """
    left = {s: c for s, c in counts.items() if c}
    bins: dict[int, dict[tuple[int, ...], int]] = defaultdict(dict)  # gap -> lengths inside -> how many
    gaps: list[int] = []

    def open_bins(inside: tuple[int, ...], n: int) -> None:
        gap = capacity - sum(inside)
        if gap not in bins or not bins[gap]:
            insort(gaps, gap)
        bins[gap][inside] = bins[gap].get(inside, 0) + n

    large = sorted(s for s in left if 3 * s > capacity)
    while large:
        a = large[-1]
        i = len(large) - 1
        while i >= 0 and large[i] > capacity - a:
            i -= 1
        if i < 0:
            open_bins((a,), left.pop(a))
            large.pop()
            continue
        b = large[i]
        n = left[a] // 2 if a == b else min(left[a], left[b])
        if not n:  # one of its kind, and it fits beside no other
            i -= 1
            if i < 0:
                open_bins((a,), left.pop(a))
                large.pop()
                continue
            b, n = large[i], 1
        open_bins((a, b), n)
        for s in (a, b):
            left[s] -= n
        for s in {a, b}:
            if not left[s]:
                del left[s]
                large.remove(s)

    for s in sorted((s for s in left if 3 * s <= capacity), reverse=True):
        n = left[s]
        while n:
            i = bisect_left(gaps, s)
            if i == len(gaps):
                each = capacity // s
                if n >= each:
                    open_bins((s,) * each, n // each)
                    n %= each
                else:
                    open_bins((s,) * n, 1)
                    n = 0
                continue
            gap = gaps[i]
            inside, have = bins[gap].popitem()
            if not bins[gap]:
                gaps.pop(i)
            each = min(gap // s, n)  # the bin just filled is the best fit for the next of this length
            k = min(have, n // each)
            if have > k:
                open_bins(inside, have - k)
            open_bins(inside + (s,) * each, k)
            n -= k * each
    return [(inside, n) for kinds in bins.values() for inside, n in sorted(kinds.items())]


def segments(kinds: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """Places by length: (length, first rank, pieces, first sequence, pieces per sequence, first offset).

    A run of equal lengths inside a kind of sequence is one segment: its rank r
    goes to sequence first + r // per, offset first offset + length * (r % per).
    """
    out, used, sequence = [], defaultdict(int), 0
    for inside, n in kinds:
        offset, i = 0, 0
        while i < len(inside):
            s, per = inside[i], 1
            while i + per < len(inside) and inside[i + per] == s:
                per += 1
            out.append((s, used[s], n * per, sequence, per, offset))
            used[s] += n * per
            offset += s * per
            i += per
        sequence += n
    return sorted(out)


def pack(docs: DataFrame, p: Packing = Packing(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "packing")
    cut = scratch.put(pieces(docs, p, id_col, text_col).withColumn("task", F.spark_partition_id()))
    # a task's rows of one length are numbered from the rows of earlier tasks
    counts = cut.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n"))
    totals = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = np.asarray(segments(plan(totals, p.capacity)), np.int64).reshape(-1, 6)
    from pyspark.sql import Window as W
    before = F.coalesce(F.sum("n").over(
        W.partitionBy("length").orderBy("task").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select("task", "length", before.alias("before")).groupBy("task").agg(
        F.map_from_entries(F.collect_list(F.struct("length", "before"))).alias("before"))
    lengths, firsts = places[:, 0], places[:, 1]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            at = np.empty(len(length), np.int64)
            for s in np.unique(length):
                lo, hi = np.searchsorted(lengths, [s, s + 1])
                mine = length == s
                at[mine] = lo + np.searchsorted(firsts[lo:hi], rank[mine], side="right") - 1
            seg = places[at]
            k = rank - seg[:, 1]
            extra = [pa.array(seg[:, 3] + k // seg[:, 4]), pa.array(seg[:, 5] + length * (k % seg[:, 4]))]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in names] + extra,
                                             names=[*names, "sequence_id", "offset"])

    # task and length together deal the rows evenly; the number within them is the order of the piece
    within = F.row_number().over(W.partitionBy("task", "length").orderBy("doc_id", "piece", "ids_crc32")) - 1
    ranked = cut.withColumn("within", within).join(starts, "task").withColumn(
        "rank", F.col("within") + F.element_at("before", F.col("length")))
    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", F.col("rank").cast("long").alias("rank")
                         ).mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, "
                                             "sequence_id long, offset long")


def op7_bestfit_packing(spark, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 1024 tokens."""
    return pack(load(spark, sf_dir, "documents"))
