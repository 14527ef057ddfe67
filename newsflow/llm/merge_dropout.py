"""Operator 8: SentencePiece encoding with seeded merge dropout, and decoding.

A merge-type model joins the adjacent pair whose result scores best, leftmost
first, until no pair joins.  With dropout, a candidate merge is left out when a
keyed hash of (seed, document, occurrence, its place) falls below the rate; the
same key gives the same segmentation on any worker and in any order.  Every
occurrence of a word is cut on its own, within and across documents.

Leaving out a merge that would not be made changes nothing.  So the merges made
are remembered per segment and set of places left out, only those are hashed for
an occurrence, and the set grows until every merge made is allowed: the exact
result, while frequent words are merged once per set and not per occurrence.  A
segment that stands once in some texts is merged for that occurrence alone.

No piece of a merge model joins the end of a word to the space after it, so a
text is encoded by segments (spaces and the run behind them).  Short segments are
merged together in numpy, one merge of each a round; long ones by a heap.

Decoding inverts any segmentation: pieces are bytes, the space mark is a space,
and a literal space mark (U+2581) in a text is encoded by byte pieces.

Defined cases: null and empty texts have no ids and decode to the empty text;
characters outside the vocabulary become byte pieces; repeated rows give equal
ids (the document's key is its id and text; a null id counts as 0); further
columns are ignored.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, islice, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.llm.common import arrow_map, mix64, texts

RATE = 0.1
#: Segments and places left out that a worker remembers; beyond it the memory starts anew (results are the same).
CACHE_SEGMENTS = 800_000
SPACE = "▁"
# Marks before which a segment may end, if the model allows.
MARKS = ".,;:!?|\n"
#: Segments up to this length are merged together; their merges fit the low bits of a key.
SHORT = 40
#: Characters of text whose new segments are merged in one go.
TOGETHER = 1 << 22
#: Occurrences whose merges are hashed in one go.
HASHED = 1 << 20
#: No place: fills the rows of places left out.
NOWHERE = np.uint64(2 ** 64 - 1)
NEVER = np.iinfo(np.int32).max
A, B, C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


class MergeModel:
    """Pieces, their order of merging and their bytes, read from a model file."""

    def __init__(self, path: str) -> None:
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = sp.get_piece_size()
        self.bytes_of: list[bytes] = []
        self.byte_id = [0] * 256
        self.ids: dict[str, int] = {}
        for i in range(self.size):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte_id[int(piece[3:5], 16)] = i
                self.bytes_of.append(bytes([int(piece[3:5], 16)]))
            elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                self.bytes_of.append(b"")
            else:
                self.bytes_of.append(piece.replace(SPACE, " ").encode())
                self.ids[piece] = i
        scores = np.array([sp.get_score(i) for i in range(self.size)])
        self.order = np.unique(-scores, return_inverse=True)[1].astype(np.int32)
        pairs = sorted((self.ids[p[:k]] * self.size + self.ids[p[k:]], i) for p, i in self.ids.items()
                       for k in range(1, len(p)) if p[:k] in self.ids and p[k:] in self.ids)
        inside = "".join(m for m in MARKS if not any(
            b == m and a not in MARKS and a != SPACE for p in self.ids for a, b in zip(p, p[1:])))
        marks = re.escape(inside)
        self.segment = re.compile(f" *[^ {marks}]+| *[{marks}]+[^ {marks}]*| +" if marks else " *[^ ]+| +")
        self.symbol = -1 - np.arange(0x110000, dtype=np.int32)  # of a code point: its piece, or itself (also a literal space mark)
        for piece, i in self.ids.items():
            if len(piece) == 1:
                self.symbol[ord(" " if piece == SPACE else piece)] = i
        self.symbol[ord(SPACE)] = -1 - ord(SPACE)
        self._tabulate(np.array([p[0] for p in pairs], np.int64), np.array([p[1] for p in pairs], np.int64))

    def _tabulate(self, key: np.ndarray, piece: np.ndarray) -> None:
        """Pairs in a table of hash buckets, one row of buckets for each place that a
        bucket needs; a pair is looked up by reading its bucket in every row."""
        self.slots = np.uint64(max(8, 2 + int(len(key)).bit_length()))
        bucket = self._bucket(key)
        order = np.argsort(bucket, kind="stable")
        bucket, key, piece = bucket[order], key[order], piece[order]
        first = np.flatnonzero(np.diff(bucket, prepend=-1))
        row = np.arange(len(bucket)) - np.repeat(first, np.diff(np.append(first, len(bucket))))
        shape = (int(row.max(initial=0)) + 1, 1 << int(self.slots))
        self.pair_key, self.pair_id = np.full(shape, -1, np.int64), np.full(shape, -1, np.int64)
        self.pair_key[row, bucket], self.pair_id[row, bucket] = key, piece

    def _bucket(self, key: np.ndarray) -> np.ndarray:
        return (key.astype(np.uint64) * A >> (np.uint64(64) - self.slots)).astype(np.int64)

    def merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece that each pair joins to, or -1."""
        key = np.where((left >= 0) & (right >= 0), left.astype(np.int64) * self.size + right, -2)
        at = self._bucket(key)
        out = np.where(self.pair_key[0][at] == key, self.pair_id[0][at], -1)
        rest = np.flatnonzero((out < 0) & (key >= 0))
        for keys, ids in zip(self.pair_key[1:], self.pair_id[1:]):
            place = at[rest]
            hit = keys[place] == key[rest]
            out[rest[hit]] = ids[place[hit]]
            rest = rest[~hit & (keys[place] >= 0)]
            if not len(rest):
                break
        return out


class Encoder:
    def __init__(self, model: MergeModel, rate: float = RATE, seed: int = 0) -> None:
        self.m, self.rate, self.seed = model, rate, seed
        self.limit = np.uint64(min(int(rate * 2.0 ** 64), 2 ** 64 - 1))
        self._forget()

    def _forget(self) -> None:
        """A cut: a segment without the merges at some places."""
        self.cut_of: dict[str, int] = {}  # of a segment without any left out
        self.after: dict[int, int] = {}  # (cut, which of its merges are left out too) -> cut
        self.segments: list[str] = []
        self.long: list[int] = []  # cuts of segments that are merged for each occurrence
        self.ids: list[bytes] = []
        self.places = np.zeros(0, np.uint64)  # of the merges made, cut after cut
        self.start = np.zeros(1, np.int64)
        self.gone, self.gone_start = self.places, self.start  # places left out, cut after cut

    def encode(self, text: str, key: int = 0) -> np.ndarray:
        """Ids of a text; ``key`` names the document."""
        return self.encode_all([text], [key])[0]

    def encode_all(self, all_texts: list[str], keys: list[int]) -> list[np.ndarray]:
        """Ids of many texts; segments not met before are merged together."""
        out: list[np.ndarray] = []
        wanted: list[tuple[int, str]] = []
        size = 0
        for i, (text, key) in enumerate(zip(all_texts, keys)):
            wanted.append((key, text))
            size += len(text)
            if size > TOGETHER or i == len(all_texts) - 1:
                out += self._look_up(wanted)
                wanted, size = [], 0
        return out

    def _look_up(self, wanted: list[tuple[int, str]]) -> list[np.ndarray]:
        found = [self.m.segment.findall(" " + text) if text else [] for _, text in wanted]
        if len(self.ids) > CACHE_SEGMENTS:
            self._forget()
        flat = list(chain.from_iterable(found))
        sizes = [len(f) for f in found]
        keys = mix64(np.repeat(self._keys(wanted), sizes) + np.concatenate([np.arange(n, dtype=np.uint64) for n in sizes]) * A)
        cuts = np.fromiter(map(self.cut_of.get, flat, repeat(-1)), np.int64, len(flat))
        unknown = np.flatnonzero(cuts < 0).tolist()
        first: dict[str, int] = {}
        often = {s for i in unknown if first.setdefault(s := flat[i], i) != i or not self.limit or len(s) > SHORT}
        self.cut_of.update(zip(often, self._add(list(often), np.zeros((len(often), 0), np.uint64))))
        cuts[unknown] = [self.cut_of.get(flat[i], -1) for i in unknown]
        for a in range(0, len(cuts), HASHED):
            self._drop(cuts[a:a + HASHED], keys[a:a + HASHED])
        # a segment met once here is merged for its occurrence alone, and so is a long one
        once = np.flatnonzero(cuts < 0)
        ids = self.ids + self._alone([flat[i] for i in once.tolist()], keys[once])
        cuts[once] = np.arange(len(self.ids), len(ids))
        got = list(map(ids.__getitem__, cuts.tolist()))
        for i in np.flatnonzero(np.isin(cuts, self.long)).tolist() if self.long else ():
            got[i] = self._by_heap(flat[i], keys[i:i + 1])
        each = iter(got)
        return [np.frombuffer(b"".join(islice(each, n)), "<i4") for n in sizes]

    def _alone(self, segments: list[str], keys: np.ndarray) -> list[bytes]:
        ids: list = [b""] * len(segments)
        for rows, n in _by_length(segments):
            for i, got in zip(rows.tolist(), self._together([segments[i] for i in rows.tolist()], n, keys[rows])):
                ids[i] = got
        return ids

    def _drop(self, cuts: np.ndarray, key: np.ndarray) -> None:
        """Turns the cuts of whole segments into those of their occurrences, given the occurrences' keys."""
        going = np.flatnonzero(cuts >= 0) if self.limit else np.zeros(0, np.int64)
        while len(going):
            at = cuts[going]
            which_place, owner, place = self._spread(self.start, at)
            hit = np.flatnonzero(self._skipped(key[going][owner], self.places[which_place]))
            if not len(hit):
                break
            who = owner[hit]
            lead = np.flatnonzero(np.diff(who, prepend=-1))
            which = at[who[lead]] << SHORT | np.add.reduceat(np.int64(1) << place[hit], lead)
            going = going[who[lead]]
            each, inverse = np.unique(which, return_inverse=True)
            new = [w for w in each.tolist() if w not in self.after]
            if new:
                self.after.update(zip(new, self._add(*self._narrowed(np.array(new)))))
            cuts[going] = np.fromiter(map(self.after.__getitem__, each.tolist()), np.int64, len(each))[inverse]

    def _narrowed(self, which: np.ndarray) -> tuple[list[str], np.ndarray]:
        """Segments and places left out (a padded row each) of cuts that leave out more of their merges."""
        cut = which >> SHORT
        more, row, at = self._spread(self.start, cut)
        taken = (which[row] >> at & 1).astype(bool)
        known, owner, _ = self._spread(self.gone_start, cut)
        value = np.concatenate([self.gone[known], self.places[more[taken]]])
        owner = np.concatenate([owner, row[taken]])
        order = np.argsort(owner, kind="stable")
        value, owner = value[order], owner[order]
        size = np.bincount(owner, minlength=len(which))
        out = np.full((len(which), int(size.max())), NOWHERE)
        out[owner, np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size)] = value
        return [self.segments[c] for c in cut.tolist()], out

    @staticmethod
    def _spread(start: np.ndarray, cut: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(index, which cut, place in it) of all entries that ``start`` lists for the cuts."""
        n = start[cut + 1] - start[cut]
        row = np.repeat(np.arange(len(cut)), n)
        at = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        return start[cut][row] + at, row, at

    def _add(self, segments: list[str], without: np.ndarray) -> range:
        """New cuts of segments, each with its row of places left out."""
        ids: list = [b""] * len(segments)
        made: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), self.places[:0])]
        for rows, n in _by_length(segments):
            group = rows.tolist()
            if n > SHORT:
                if self.limit:
                    self.long += [len(self.ids) + i for i in group]
                else:
                    for i in group:
                        ids[i] = self._by_heap(segments[i], np.zeros(1, np.uint64))
                continue
            steps: list[tuple[np.ndarray, np.ndarray]] = []
            for i, got in zip(group, self._together([segments[i] for i in group], n, without[rows], steps)):
                ids[i] = got
            if self.limit:
                made += [(rows[row], place) for row, place in steps]
        first = len(self.ids)
        self.ids += ids
        self.segments += segments
        if segments:
            row, place = (np.concatenate(x) for x in zip(*made))
            self.places = np.concatenate([self.places, place[np.argsort(row, kind="stable")]])
            self.start = np.concatenate([self.start, self.start[-1] + np.cumsum(np.bincount(row, minlength=len(segments)))])
            left = without != NOWHERE
            self.gone = np.concatenate([self.gone, without[left]])
            self.gone_start = np.concatenate([self.gone_start, self.gone_start[-1] + np.cumsum(left.sum(1))])
        return range(first, len(self.ids))

    def decode(self, ids: list[int] | np.ndarray) -> str:
        return b"".join(map(self.m.bytes_of.__getitem__, np.asarray(ids, np.int64).tolist())).decode("utf-8", "surrogatepass")[1:]

    def _keys(self, wanted: list[tuple[int, str]]) -> np.ndarray:
        """Keys of (document, text)."""
        return np.array([xxhash.xxh64_intdigest(s.encode("utf-8", "surrogatepass"), xxhash.xxh64_intdigest(f"{self.seed}:{w}"))
                         for w, s in wanted], np.uint64)

    def _skipped(self, key: np.ndarray, place: np.ndarray) -> np.ndarray:
        return mix64(key + place) < self.limit

    def _symbols(self, joined: str) -> np.ndarray:
        return self.m.symbol[np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)].astype(np.int64)

    def _spell(self, symbols: np.ndarray) -> bytes:
        """Ids as little-endian bytes; a symbol outside the vocabulary becomes byte pieces."""
        if symbols.min() < 0:
            symbols = np.array(list(chain.from_iterable(
                [s] if s >= 0 else [self.m.byte_id[b] for b in chr(-1 - s).encode("utf-8", "surrogatepass")]
                for s in symbols.tolist())))
        return symbols.astype("<i4").tobytes()

    def _ranked(self, left: np.ndarray, right: np.ndarray, key: np.ndarray, start: np.ndarray,
                mid: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Ranks of candidate merges; ``key``: of each occurrence, or the places left out, a row of them each."""
        joined = self.m.merged(left, right)
        ok = joined >= 0
        if key.ndim == 1:
            ok[ok] = ~self._skipped(key[ok], _place(start[ok], mid[ok], end[ok]))
        elif key.shape[1]:
            ok[ok] = ~(key[ok] == _place(start[ok], mid[ok], end[ok])[:, None]).any(1)
        return np.where(ok, self.m.order[joined], NEVER)

    def _together(self, segments: list[str], n: int, key: np.ndarray, steps: list | None = None) -> list[bytes]:
        """Segments of one length: each round does the best merge of each (its row and place go to ``steps``)."""
        rows = len(segments)
        sym = self._symbols("".join(segments)).reshape(rows, n)
        at = np.broadcast_to(np.arange(n + 1), (rows, n + 1)).copy()  # where symbols start; the end
        out: list = [None] * rows
        row = np.arange(rows)
        rank = np.empty((rows, n - 1), np.int32)
        for j in range(n - 1):
            rank[:, j] = self._ranked(sym[:, j], sym[:, j + 1], key, at[:, j], at[:, j + 1], at[:, j + 2])
        while len(row):
            width = sym.shape[1]
            if width > 1:
                best = rank.argmin(1)
                going = rank[np.arange(len(row)), best] < NEVER
            else:
                best, going = None, np.zeros(len(row), bool)
            done = sym[~going]
            plain, wide = done.astype("<i4").tobytes(), 4 * width
            for i, (r, odd) in enumerate(zip(row[~going].tolist(), (done < 0).any(1).tolist())):
                out[r] = self._spell(done[i]) if odd else plain[i * wide:(i + 1) * wide]
            if not going.any():
                break
            row, sym, at, rank, key, best = row[going], sym[going], at[going], rank[going], key[going], best[going]
            i = np.arange(len(row))
            if steps is not None:
                steps.append((row, _place(at[i, best], at[i, best + 1], at[i, best + 2])))
            sym[i, best] = self.m.merged(sym[i, best], sym[i, best + 1])
            sym = _without(sym, best + 1)
            at = _without(at, best + 1)
            rank = _without(rank, best)
            for j in (best - 1, best):
                w = np.flatnonzero((j >= 0) & (j < sym.shape[1] - 1))
                k = j[w]
                rank[w, k] = self._ranked(sym[w, k], sym[w, k + 1], key[w], at[w, k], at[w, k + 1], at[w, k + 2])
        return out

    def _by_heap(self, segment: str, key: np.ndarray) -> bytes:
        """The same for one long segment: an agenda of candidate merges."""
        sym = self._symbols(segment).tolist()
        n = len(sym)
        end, prev, nxt = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
        m, agenda = self.m, []
        a = np.arange(n - 1)
        rank = self._ranked(np.array(sym[:-1]), np.array(sym[1:]), np.repeat(key, n - 1), a, a + 1, a + 2)
        agenda = [(int(r), i, i + 1, i + 2) for i, r in enumerate(rank.tolist()) if r < NEVER]
        heapq.heapify(agenda)
        one = np.array

        def propose(i: int, j: int) -> None:
            if i >= 0 and j < n:
                r = self._ranked(one([sym[i]]), one([sym[j]]), key, one([i]), one([j]), one([end[j]]))[0]
                if r < NEVER:
                    heapq.heappush(agenda, (int(r), i, j, end[j]))

        alive = [True] * n
        while agenda:
            _, i, j, stop = heapq.heappop(agenda)
            if not (alive[i] and j < n and alive[j] and nxt[i] == j and end[j] == stop and end[i] == j):
                continue
            sym[i] = int(m.merged(one([sym[i]]), one([sym[j]]))[0])
            alive[j] = False
            end[i], nxt[i] = end[j], nxt[j]
            if nxt[i] < n:
                prev[nxt[i]] = i
            propose(prev[i], i)
            propose(i, nxt[i])
        return self._spell(np.array([s for s, a_ in zip(sym, alive) if a_]))


def _place(start: np.ndarray, mid: np.ndarray, end: np.ndarray) -> np.ndarray:
    u = np.uint64
    return start.astype(u) * A + mid.astype(u) * B + end.astype(u) * C


def _by_length(segments: list[str]) -> Iterator[tuple[np.ndarray, int]]:
    """(which, length) of the segments of each length."""
    size = np.fromiter(map(len, segments), np.int64, len(segments))
    order = np.argsort(size, kind="stable")
    for rows in np.split(order, np.flatnonzero(np.diff(size[order])) + 1):
        if len(rows):
            yield rows, int(size[rows[0]])


def _without(x: np.ndarray, column: np.ndarray) -> np.ndarray:
    """``x`` without one column of each row."""
    keep = np.ones(x.shape, bool)
    keep[np.arange(len(x)), column] = False
    return x[keep].reshape(len(x), x.shape[1] - 1)


@lru_cache(maxsize=1)
def worker_encoder(path: str, rate: float, seed: int) -> Encoder:
    """One encoder a worker process: its model and memory serve all the tasks it runs."""
    return Encoder(MergeModel(path), rate, seed)


def encode(docs: DataFrame, model_path: str, rate: float = RATE, seed: int = 0) -> DataFrame:
    """doc_id, ids: one scan, no shuffle."""
    return _run(docs, model_path, rate, seed, lambda e, ids, text: ids, pa.list_(pa.int32()), "array<int>")


def decode(encoded: DataFrame, model_path: str) -> DataFrame:
    """doc_id, text of (doc_id, ids) rows; null ids give the empty text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = worker_encoder(model_path, 0.0, 0)
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "text": pa.array(
                [e.decode(ids or []) for ids in batch.column("ids").to_pylist()], pa.string())})
    return arrow_map(encoded.select("doc_id", "ids"), run, "doc_id long, text string")


def round_trip(docs: DataFrame, model_path: str, rate: float = RATE, seed: int = 0) -> DataFrame:
    """doc_id, n_tokens, ids_crc32 (unsigned little-endian 32-bit ids) and lossless:
    whether the ids decode to the text."""
    def made(e: Encoder, ids: np.ndarray, text: str) -> dict:
        return {"n_tokens": len(ids), "ids_crc32": zlib.crc32(ids.tobytes()), "lossless": e.decode(ids) == text}
    kind = pa.struct([("n_tokens", pa.int64()), ("ids_crc32", pa.int64()), ("lossless", pa.bool_())])
    got = _run(docs, model_path, rate, seed, made, kind, "struct<n_tokens:long,ids_crc32:long,lossless:boolean>")
    return got.select("doc_id", "ids.*")


def _run(docs: DataFrame, model_path: str, rate: float, seed: int, made, kind: pa.DataType, ddl: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = worker_encoder(model_path, rate, seed)
        for batch in batches:
            held = texts(batch)
            ids = e.encode_all(held, [k or 0 for k in batch.column("doc_id").to_pylist()])
            rows = [made(e, i, t) for i, t in zip(ids, held)]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "ids": pa.array(rows, kind)})
    return arrow_map(docs.select(F.col("doc_id").cast("long"), "text"), run, f"doc_id long, ids {ddl}")
