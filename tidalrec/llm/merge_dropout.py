"""SentencePiece encoding with seeded merge dropout, and lossless decoding.

Text is cut into units that no piece of the model crosses (before each run of
spaces, around line breaks and tabs).  Inside a unit, neighbouring symbols whose
concatenation is a piece are candidate merges on an agenda ordered by the
piece's score, then from left to right; a candidate whose keyed hash falls below
the dropout rate is skipped when its turn comes and stays out until its symbols
change.  The key holds the seed, the document's id, the unit's position in the
document and the number of the turn, so each occurrence of a unit draws for
itself.  A segmentation depends on the unit and on the turns skipped alone, so a
worker keeps those it has seen as a tree: from a unit's node without a skip, one
child for each turn that may be skipped next; a full tree goes on with the half
of its nodes used most.  Occurrences walk down the tree turn by turn; where a child is missing, the agendas of all such occurrences of a
group of texts advance together, one candidate each per turn, as numpy rows;
long units go through a heap one at a time, with the same result.  With rate 0
the result is the model's own encoding.

Symbols that are no piece become byte pieces, as does U+2581 itself (the mark
that stands for a space), so decoding restores every text exactly.

Defined cases: a null or empty text has no ids and decodes to an empty text;
rows that share an id draw alike; an empty table gives an empty result; other
columns are never read.
"""

from __future__ import annotations

import heapq
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidalrec.llm.common import load, mix64

SPACE = "▁"
_NEVER = np.iinfo(np.int32).max
GROUP_CHARS = 500_000    # texts are handled together up to this many characters; a longer one alone
_LONG = 48               # longer units are segmented one at a time
_STEP, _ROWS = 4, 30_000  # the others in rows as wide as the next multiple of _STEP, _ROWS at a time


@dataclass(frozen=True)
class Dropout:
    rate: float = 0.1
    seed: int = 9
    model: str | None = None        # path of a sentencepiece BPE model; None: public piece_bpe_32k.model
    cache_units: int = 400_000      # per worker; only memory and speed depend on it


class Pieces:
    """Pieces of a BPE model with byte fallback; enough to decode."""

    def __init__(self, p: Dropout):
        import sentencepiece as spm
        path = p.model
        if path is None:
            import public_tokenizers
            path = public_tokenizers.path("piece_bpe_32k.model")
        sp = spm.SentencePieceProcessor(model_file=path)
        self._size = sp.get_piece_size()
        self._ids: dict[str, int] = {}
        self._bytes: dict[int, int] = {}
        order = []
        for i in range(self._size):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self._bytes[int(piece[1:-1], 16)] = i
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                self._ids[piece] = i
                order.append((-sp.get_score(i), i, piece))
        self._rank = {piece: r for r, (_, _, piece) in enumerate(sorted(order)) if len(piece) > 1}
        bytes_of = {i: piece.replace(SPACE, " ").encode() for piece, i in self._ids.items()}
        bytes_of |= {i: bytes([b]) for b, i in self._bytes.items()}
        # the bytes of all pieces in one array; ids that stand for no bytes have none
        self._n_bytes = np.zeros(self._size, np.int64)
        self._n_bytes[list(bytes_of)] = list(map(len, bytes_of.values()))
        self._from = np.cumsum(self._n_bytes) - self._n_bytes
        self._pool = np.frombuffer(b"".join(bytes_of[i] for i in sorted(bytes_of)), np.uint8)

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids: the bytes of the pieces as UTF-8, without the first space."""
        return self.decode_all(np.asarray(ids), np.array([len(ids)]))[0].as_py()

    def decode_all(self, ids: np.ndarray, counts: np.ndarray) -> pa.StringArray:
        """The texts of consecutive runs of ids, of ``counts`` ids each."""
        if len(ids) and not 0 <= ids.min() <= ids.max() < self._size:
            raise KeyError("an id outside the model")
        sizes, begin = self._n_bytes[ids], self._from[ids]
        if not sizes.all():
            raise KeyError(int(ids[sizes.argmin()]))
        last = np.cumsum(counts)
        first = (last - counts)[counts > 0]
        sizes[first] -= 1
        begin[first] += 1
        ends = np.concatenate([[0], np.cumsum(sizes)])
        blocks = [np.empty(0, np.uint8)]
        for a in range(0, len(ids), GROUP_CHARS):
            b = min(a + GROUP_CHARS, len(ids))
            blocks.append(self._pool[np.repeat(begin[a:b] - ends[a:b], sizes[a:b]) + np.arange(ends[a], ends[b])])
        data = np.concatenate(blocks)
        offsets = np.concatenate([[0], ends[last]]).astype(np.int32)
        texts = pa.StringArray.from_buffers(len(counts), pa.py_buffer(offsets), pa.py_buffer(data))
        texts.validate(full=True)
        return texts


class Codec(Pieces):
    """Encoder and decoder."""

    def __init__(self, p: Dropout):
        super().__init__(p)
        self._rank_of = self._rank.get
        if any(SPACE in piece.lstrip(SPACE) for piece in self._rank):
            raise ValueError("a piece of the model crosses a space")
        alone = "".join(c for c in "\n\t\r\0" if not any(c in piece for piece in self._rank))
        self._alone = alone.replace("\0", "")
        self._p = p
        self._below = np.uint64(int(p.rate * 2.0**32))
        self._forget()
        # the same tables for numpy: id of a character, and what two neighbouring pieces merge into
        self._char_id = np.full(0x110000, -1, np.int32)
        for piece, i in self._ids.items():
            if len(piece) == 1:
                self._char_id[ord(piece)] = i
        self._rank_by_id = np.full(self._size + 1, _NEVER, np.int32)
        pairs: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for piece, r in self._rank.items():
            self._rank_by_id[self._ids[piece]] = r
            for k in range(1, len(piece)):
                left, right = self._ids.get(piece[:k]), self._ids.get(piece[k:])
                if left is not None and right is not None:
                    pairs[left].append((right, self._ids[piece]))
        self._place(pairs)

    def _place(self, pairs: dict[int, list[tuple[int, int]]]) -> None:
        """One table of all pairs: a left piece's right ones lie at their ids from a place where no other's lie."""
        room = max(self._size, 8 * sum(map(len, pairs.values())))
        self._shift = np.zeros(self._size + 1, np.int64)
        self._pair = np.full(room + self._size + 1, -1, np.int64)      # left << 32 | merged
        shift = 0
        for left, some in sorted(pairs.items(), key=lambda x: -len(x[1])):
            right, merged = np.array(some).T
            for _ in range(200):
                if (self._pair[right + shift] < 0).all():
                    break
                shift = (shift + 0x9E3779B1) % room
            else:                                                       # a place of its own
                shift = len(self._pair)
                self._pair = np.append(self._pair, np.full(self._size + 1, -1))
            self._shift[left] = shift
            self._pair[right + shift] = left << 32 | merged
            shift %= room

    # -- segmentation

    def _key(self, unit: str, draw: int) -> int:
        """What an occurrence's hashes are keyed with: its draw holds seed, id and position, whatever the unit."""
        return draw

    def _skipped(self, keys: np.ndarray, turn: int | np.ndarray) -> np.ndarray:
        """Whether the candidate whose turn it is gets skipped (uint64 keys)."""
        return self._below_rate(mix64(keys), turn)

    def _below_rate(self, seeds: np.ndarray, turn: int | np.ndarray) -> np.ndarray:
        """``_skipped`` of keys that are mixed already."""
        step = np.asarray(turn, np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return mix64(seeds + step) >> np.uint64(32) < self._below

    def segment(self, unit: str, draw: int) -> list[str]:
        """Pieces of a unit: the best candidate first, then the leftmost."""
        n, rank_of = len(unit), self._rank_of
        # at most n - 1 candidates at first and two more for each merge
        skips = iter(self._skipped(np.array([self._key(unit, draw)], np.uint64), np.arange(3 * n)).tolist())
        ends, prev = list(range(1, n + 1)), list(range(-1, n - 1))   # by the symbol's start; end 0: merged away
        heap: list[tuple[int, int, int, int]] = []

        def offer(start: int) -> None:
            mid = ends[start]
            if mid < n:
                rank = rank_of(unit[start:ends[mid]], _NEVER)
                if rank != _NEVER:
                    heapq.heappush(heap, (rank, start, mid, ends[mid]))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, start, mid, end = heapq.heappop(heap)
            if ends[start] != mid or mid >= n or ends[mid] != end:
                continue  # one of its symbols has changed
            if next(skips):
                continue
            ends[start], ends[mid] = end, 0
            if end < n:
                prev[end] = start
            if prev[start] >= 0:
                offer(prev[start])
            offer(start)
        out, i = [], 0
        while i < n:
            out.append(unit[i:ends[i]])
            i = ends[i]
        return out

    def _merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ids of the pieces that neighbouring pieces make; the id after the last where they make none."""
        found = self._pair[self._shift[left] + right]
        return np.where(found >> 32 == left, found & 0xFFFFFFFF, self._size)

    def _segment_rows(self, chars: np.ndarray, keys: np.ndarray | None, turns: np.ndarray | None = None,
                      last: np.ndarray | None = None) -> np.ndarray:
        """Ids after all merges of units given as rows of character ids; -1 where merged away.

        A negative id is never merged.  Without keys nothing is skipped.  ``turns``
        and ``last``, if given, receive each row's number of turns and the last turn
        it skipped.
        """
        rows, n = chars.shape
        seeds = None if keys is None else mix64(np.asarray(keys).astype(np.uint64))
        # all rows in one array, a cell without a piece after each; the first row's left neighbour is the last cell
        none, width, cells = self._size, n + 1, rows * (n + 1)
        ids = np.full((rows, width), none, np.int64)
        ids[:, :n] = np.where(chars < 0, none, chars)
        ids = ids.ravel()
        into = self._merged(ids, np.append(ids[1:], none))               # by the left symbol's cell
        rank = self._rank_by_id[into]
        by_row = rank.reshape(rows, width)
        nxt, prv = np.arange(1, cells + 1), np.arange(-1, cells - 1)
        turn, live = 0, np.arange(rows)
        while True:
            start = (by_row if len(live) == rows else by_row[live]).argmin(axis=1)
            start += live * width
            found = rank[start] != _NEVER
            if not found.all():
                live, start = live[found], start[found]
            if not len(live):
                break
            if turns is not None:
                turns[live] = turn + 1
            if seeds is not None:
                skip = self._below_rate(seeds[live], turn)
                rank[start[skip]] = _NEVER
                if last is not None:
                    last[live[skip]] = turn
                start = start[~skip]
            turn += 1
            mid = nxt[start]
            end = nxt[mid]
            ids[start] = into[start]
            ids[mid] = -1
            rank[mid] = _NEVER
            nxt[start] = end
            prv[end] = start
            x, y = np.concatenate([prv[start], start]), np.concatenate([start, end])
            into[x] = m = self._merged(ids[x], ids[y])
            rank[x] = self._rank_by_id[m]
        ids = ids.reshape(rows, width)[:, :n]
        return np.where(ids == none, chars, ids).astype(np.int32)

    def _forget(self) -> None:
        """Empties the tree; node 0 stands for occurrences that are segmented on their own."""
        self._node: dict[str | bytes, int] = {}      # a unit's node without a skip
        self._child: dict[int, int] = {}             # by parent << 16 | turn skipped next
        self._blobs = [b""]
        self._turns, self._uses = np.zeros(1024, np.int64), np.zeros(1024, np.int64)

    def _thin(self) -> None:
        """Keeps the nodes used most, half of the cache at most; a parent is used no less than its children."""
        uses = self._uses[:len(self._blobs)]
        order, half = np.sort(uses[1:])[::-1], self._p.cache_units // 2
        keep = uses > (order[half] if half < len(order) else 0)
        keep[0] = True
        kept, to = np.flatnonzero(keep), (np.cumsum(keep) - 1).tolist()
        keep = keep.tolist()
        self._node = {unit: to[i] for unit, i in self._node.items() if keep[i]}
        self._child = {to[w >> 16] << 16 | w & 0xFFFF: to[i] for w, i in self._child.items() if keep[i]}
        self._blobs = [self._blobs[i] for i in kept.tolist()]
        self._turns, self._uses = self._turns[kept], uses[kept] // 2

    def _add(self, blobs: list[bytes], turns: np.ndarray) -> range:
        at, end = len(self._blobs), len(self._blobs) + len(blobs)
        if end > len(self._turns):
            self._turns = np.concatenate([self._turns, np.zeros(end, np.int64)])
            self._uses = np.concatenate([self._uses, np.zeros(end, np.int64)])
        self._blobs += blobs
        self._turns[at:end] = turns
        self._uses[at:end] = 1
        return range(at, end)

    def _segment_all(self, units: list[str], keys: np.ndarray | None
                     ) -> Iterator[tuple[list[int], list[bytes], np.ndarray, np.ndarray]]:
        """(places in units, ids, turns, last turns skipped) by width, of units of up to _LONG characters."""
        by_width: dict[int, list[int]] = defaultdict(list)
        lengths = np.fromiter(map(len, units), np.int64, len(units))
        for at, n in enumerate((-(-lengths // _STEP) * _STEP).tolist()):
            by_width[n].append(at)
        for width, some in ((n, all_[a:a + _ROWS]) for n, all_ in by_width.items() for a in range(0, len(all_), _ROWS)):
            codes = np.frombuffer("".join([units[at] for at in some]).encode("utf-32-le"), "<u4").astype(np.int32)
            filled = np.arange(width) < lengths[some][:, None]
            chars = np.full(filled.shape, -1, np.int32)
            flat = self._char_id[codes]
            chars[filled] = np.where(flat < 0, -2 - codes, flat)         # outside the model: never merged
            turns, last = np.zeros(len(some), np.int64), np.full(len(some), -1)
            ids = self._segment_rows(chars, None if keys is None else keys[some], turns, last)
            kept = ids != -1
            flat, ends = ids[kept].astype("<i4").tobytes(), (4 * np.cumsum(kept.sum(axis=1))).tolist()
            blobs = [flat[a:b] for a, b in zip([0, *ends], ends)]
            for at in np.flatnonzero((chars < -1).any(axis=1)).tolist():
                blobs[at] = self._spelled(blobs[at])
            yield some, blobs, turns, last

    def _spelled(self, blob: bytes) -> bytes:
        """Ids with the characters outside the model as byte pieces."""
        ids: list[int] = []
        for i in np.frombuffer(blob, "<i4").tolist():
            ids += [i] if i >= 0 else [self._bytes[b] for b in chr(-2 - i).encode()]
        return np.asarray(ids, "<u4").tobytes()

    def _unit_ids(self, unit: str, draw: int) -> bytes:
        ids: list[int] = []
        for piece in self.segment(unit, draw):
            i = self._ids.get(piece)
            if i is None:
                ids += [self._bytes[b] for b in piece.encode()]
            else:
                ids.append(i)
        return np.asarray(ids, "<u4").tobytes()

    # -- texts

    def _units(self, run: str) -> list[str]:
        """Units of a run without NUL and the space mark, which NUL parts here."""
        spaced = run.replace(" ", "\0" + SPACE)
        if "  " in run:
            spaced = spaced.replace(SPACE + "\0", SPACE)
        for c in self._alone:
            if c in run:
                spaced = spaced.replace(c, f"\0{c}\0")
        return list(filter(None, spaced.split("\0")))

    def _cut(self, text: str, key: int) -> tuple[list[str | bytes], np.ndarray]:
        """A text's units and their draws; the space mark itself and NUL are the ids of their bytes."""
        units: list[str | bytes] = []
        for run in re.split(f"([{SPACE}\0])", text) if SPACE in text or "\0" in text else [text]:
            if run in (SPACE, "\0"):
                units += [] if units else [SPACE]
                units.append(np.asarray([self._bytes[b] for b in run.encode()], "<u4").tobytes())
            elif run:
                units += self._units(("" if units else " ") + run)
        return units, mix64(np.arange(len(units), dtype=np.uint64) + np.uint64(key))

    def _encode_group(self, cut: list[tuple[list[str | bytes], np.ndarray]]) -> list[np.ndarray]:
        if len(self._blobs) > self._p.cache_units:
            self._thin()
        units = list(chain.from_iterable(some for some, _ in cut))
        draws = np.concatenate([np.empty(0, np.uint64), *(d for _, d in cut)])
        node_of, child_of = self._node.get, self._child.get
        node = np.fromiter(map(node_of, units, repeat(0)), np.int64, len(units))
        unknown = np.flatnonzero(node == 0).tolist()
        unseen = dict.fromkeys([units[i] for i in unknown])
        for unit in unseen:
            if isinstance(unit, bytes):
                self._node[unit], = self._add([unit], np.zeros(1))
        new = [unit for unit in unseen if isinstance(unit, str) and len(unit) <= _LONG]
        for some, blobs, turns, _ in self._segment_all(new, None):
            self._node.update(zip([new[at] for at in some], self._add(blobs, turns)))
        node[unknown] = [node_of(units[i], 0) for i in unknown]
        alone = np.flatnonzero(node == 0).tolist()
        self._uses += np.bincount(node, minlength=len(self._uses))

        lost, wanted = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        seeds = mix64(draws)
        turn, active = 0, np.flatnonzero(self._turns[node] > 0) if self._below else np.empty(0, np.int64)
        while len(active):
            hit = active[self._below_rate(seeds[active], turn)]
            want, back, times = np.unique(node[hit] << 16 | turn, return_inverse=True, return_counts=True)
            child = np.fromiter(map(child_of, want.tolist(), repeat(0)), np.int64, len(want))
            self._uses[child] += times
            node[hit] = child[back]
            gone = node[hit] == 0
            lost.append(hit[gone])
            wanted.append(want[back[gone]])
            turn += 1
            active = active[self._turns[node[active]] > turn]
        lost, wanted = np.concatenate(lost), np.concatenate(wanted)

        out = list(map(self._blobs.__getitem__, node.tolist()))
        for i in alone:
            out[i] = self._unit_ids(units[i], int(draws[i]))
        places = lost.tolist()
        for some, blobs, turns, last in self._segment_all([units[i] for i in places], draws[lost]):
            for at, blob in zip(some, blobs):
                out[places[at]] = blob
            want = wanted[some]
            just = np.flatnonzero(last == want & 0xFFFF)     # no skip after the missing child's
            want, first = np.unique(want[just], return_index=True)
            first = just[first]
            self._child.update(zip(want.tolist(), self._add([blobs[i] for i in first.tolist()], turns[first])))
        ends = np.cumsum([0, *(len(some) for some, _ in cut)]).tolist()
        return [np.frombuffer(b"".join(out[a:b]), "<u4") for a, b in zip(ends, ends[1:])]

    def encode_all(self, texts: list[str], keys: Iterable[int]) -> list[np.ndarray]:
        """Token ids of every text; a text's key and their positions give its units' draws."""
        return self._encode_group([self._cut(text, key) for text, key in zip(texts, keys)])

    def encode(self, text: str, key: int) -> np.ndarray:
        return self.encode_all([text], [key])[0]


@lru_cache(maxsize=1)
def codec_of(p: Dropout) -> Codec:
    """The worker's codec, kept with its cache from task to task."""
    return Codec(p)


@lru_cache(maxsize=1)
def pieces_of(p: Dropout) -> Pieces:
    return Pieces(p)


def _groups(batch: pa.RecordBatch, sizes: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Slices of rows whose sizes add up to about GROUP_CHARS each."""
    group = np.cumsum(sizes, dtype=np.int64) // GROUP_CHARS
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        if a < b:
            yield batch.slice(a, b - a)


def encode(docs: DataFrame, p: Dropout = Dropout(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(p)
        for batch in batches:
            for part in _groups(batch, pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy()):
                keys = [xxhash.xxh3_64_intdigest(b"%d" % (-1 if i is None else i), p.seed)
                        for i in part.column(0).to_pylist()]
                ids = codec.encode_all([t or "" for t in part.column(1).to_pylist()], keys)
                flat = pa.array(np.concatenate(ids).view(np.int32))
                ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.ListArray.from_arrays(pa.array(ends), flat)], names=["doc_id", "ids"])
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("t")).mapInArrow(
        run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, p: Dropout = Dropout()) -> DataFrame:
    """doc_id, ids, text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pieces_of(p)
        for batch in batches:
            sizes = pc.fill_null(pc.list_value_length(batch.column(1)), 0)
            for part in _groups(batch, sizes.to_numpy()):
                lists = part.column(1)
                ids = lists.flatten()
                if ids.null_count:
                    raise KeyError(None)
                texts = pieces.decode_all(ids.to_numpy(), pc.fill_null(pc.list_value_length(lists), 0).to_numpy())
                if lists.null_count:
                    texts = pc.if_else(lists.is_valid(), texts, None)
                yield pa.RecordBatch.from_arrays([part.column(0), lists, texts], names=["doc_id", "ids", "text"])
    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids array<int>, text string")


def op9_merge_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids, and length and checksum of what they decode to."""
    back = decode(encode(load(spark, sf_dir, "documents")))
    return back.select("doc_id", F.size("ids").cast("long").alias("n_ids"), "ids",
                       F.char_length("text").cast("long").alias("decoded_chars"),
                       F.crc32(F.col("text").cast("binary")).alias("decoded_crc32"))
