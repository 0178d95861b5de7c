"""SentencePiece encoding and decoding: N-best segmentation over the piece lattice."""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, functions as F

from shelfwise.llm.common import id_and_text

SPACE = "▁"  # stands for a space in pieces
SWAP = str.maketrans({" ": SPACE, SPACE: " "})
UNKNOWN_COST = 10.0
#: Segmentations of units are kept, up to so many; then the store starts anew.
KEPT_UNITS = 200_000
MIX, WORD = np.uint64(0x9E3779B97F4A7C15), (1 << 64) - 1


@dataclass
class Kept:
    """Best segmentations of units: place in the arrays, scores, losses of the second choice, ids."""

    place: dict[str, int] = field(default_factory=dict)
    score: np.ndarray = field(default_factory=lambda: np.zeros(0))
    loss: np.ndarray = field(default_factory=lambda: np.zeros(0))
    starts: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))
    ids: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    others: dict = field(default_factory=dict)

    def add(self, units: list[str], score: np.ndarray, loss: np.ndarray, sizes: np.ndarray, ids: np.ndarray) -> None:
        self.place.update(zip(units, range(len(self.place), len(self.place) + len(units))))
        self.score, self.loss = np.concatenate([self.score, score]), np.concatenate([self.loss, loss])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes)])
        self.ids = np.concatenate([self.ids, ids.astype(np.int32)])

    def ids_of(self, place: int) -> tuple[int, ...]:
        return tuple(self.ids[self.starts[place] : self.starts[place + 1]].tolist())


@dataclass
class PieceModel:
    """Pieces, scores and byte pieces of a SentencePiece model with byte fallback.

    ``ids`` maps every prefix of a piece to the piece's id, or to -1 if the prefix is none.
    """

    pieces: list[str]
    scores: list[float]
    ids: dict[str, int]
    bytes_first: int
    floor: float
    alone: str
    kept: Kept | None = field(default=None, repr=False)

    @classmethod
    def load(cls, path: str) -> PieceModel:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        count = model.get_piece_size()
        pieces, scores = [model.id_to_piece(i) for i in range(count)], [model.get_score(i) for i in range(count)]
        special = [model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i) for i in range(count)]
        return cls.of(pieces, scores, special, next(i for i in range(count) if model.is_byte(i)))

    @classmethod
    def of(cls, pieces: list[str], scores: list[float], special: list[bool], bytes_first: int) -> PieceModel:
        ids: dict[str, int] = {}
        plain = [i for i, s in enumerate(special) if not s]
        for i in plain:
            for end in range(1, len(pieces[i])):
                ids.setdefault(pieces[i][:end], -1)
        ids |= {pieces[i]: i for i in plain}
        floor = min((scores[i] for i in plain if scores[i] > -1e8), default=0.0) - UNKNOWN_COST
        joined = {c for i in plain if len(pieces[i]) > 1 for c in pieces[i]}
        crossing = any(re.search(f"[^{SPACE}]{SPACE}", pieces[i]) for i in plain)
        # A path passes both ends of a character that no longer piece holds, and every begin of a run of spaces.
        return cls(pieces, scores, ids, bytes_first, floor, "" if crossing else "".join(sorted(joined)))

    def __getstate__(self) -> dict:
        return self.__dict__ | {"kept": None}

    def units(self, prepared: str) -> list[str]:
        """Parts of a text between places that every path passes."""
        if not self.alone:
            return [prepared] if prepared else []
        if "splitter" not in self.__dict__:
            inner = re.escape(self.alone.replace(SPACE, ""))
            self.splitter = re.compile(f"{SPACE}*[{inner}]+|{SPACE}+|[^{inner}{SPACE}]")
        return self.splitter.findall(prepared)

    def lattice(self, unit: str) -> list[list[tuple[int, float, int]]]:
        """Edges by end: begin, score and piece; -1 for a character that is no piece."""
        get, scores, size = self.ids.get, self.scores, len(unit)
        into: list[list[tuple[int, float, int]]] = [[] for _ in range(size + 1)]
        for i in range(size):
            single = False
            for j in range(i + 1, size + 1):
                piece = get(unit[i:j])
                if piece is None:
                    break
                if piece >= 0:
                    into[j].append((i, scores[piece], piece))
                    single |= j == i + 1
            if not single:
                into[i + 1].append((i, self.floor, -1))
        return into

    def spelled(self, unit: str, path: list[tuple[int, int, int]]) -> tuple[int, ...]:
        """Ids along a path of (begin, end, piece); bytes for what is no piece."""
        out: list[int] = []
        for i, j, piece in path:
            if piece >= 0:
                out.append(piece)
            else:
                out += [self.bytes_first + b for b in unit[i:j].translate(SWAP).encode()]
        return tuple(out)

    def best(self, unit: str, count: int) -> list[tuple[float, tuple[int, ...]]]:
        """The ``count`` best segmentations of a unit, by falling score.

        Forward, Viterbi finds the best score up to every place.  Backward from the end, A* extends
        partial paths by what they lose against the best one, which is exact as losses only grow; so
        whole paths come out best first.  Of equal ones the path that reaches farther goes on first,
        then the one found earlier.  A place is passed by its ``count`` best partial paths at most:
        each beyond these stands behind ``count`` paths that can be completed alike.  The work is
        bounded by ``count`` times the edges, for runs of one letter, too.
        """
        into, size = self.lattice(unit), len(unit)
        ahead = [0.0] * (size + 1)
        for j in range(1, size + 1):
            ahead[j] = max([ahead[i] + score for i, score, _ in into[j]], default=float("-inf"))
        found, turn, passed = [], 0, [0] * (size + 1)
        heap = [(0.0, size, 0, 0.0, None)]
        while heap and len(found) < count:
            lost, at, _, behind, path = heapq.heappop(heap)
            if passed[at] == count:
                continue
            passed[at] += 1
            if at == 0:
                steps = []
                while path:
                    step, path = path
                    steps.append(step)
                found.append((behind, self.spelled(unit, steps)))
                continue
            for i, score, piece in into[at]:
                if passed[i] < count:
                    turn += 1
                    heapq.heappush(heap, (lost + (ahead[at] - (ahead[i] + score)), i, turn, score + behind, ((i, at, piece), path)))
        return found

    def others(self, unit: str, count: int) -> list[tuple[float, tuple[int, ...]]]:
        """The best segmentation in use and the ``count`` - 1 best besides it."""
        found = self.kept.others.get((unit, count))
        if found is None:
            place = self.kept.place[unit]
            best, used = self.best(unit, count), self.kept.ids_of(place)
            same = next((k for k, (_, ids) in enumerate(best) if ids == used), len(best) - 1)
            found = [(float(self.kept.score[place]), used), *best[:same], *best[same + 1 :]]
            if len(self.kept.others) >= KEPT_UNITS:
                self.kept.others.clear()
            self.kept.others[unit, count] = found
        return found

    def learn(self, units: set[str]) -> None:
        """Find the best segmentations of units that aren't kept."""
        if self.kept is None or len(self.kept.place) + len(units) > KEPT_UNITS:
            self.kept = Kept()
        new = [u for u in units if u not in self.kept.place]
        for low, high in ((0, 8), (8, 16), (16, 32)):
            some = [u for u in new if low < len(u) <= high]
            for s in range(0, len(some), 20_000):
                self.kept.add(some[s : s + 20_000], *self.solve(some[s : s + 20_000], high))
        for unit in new:
            if len(unit) > 32:
                (score, ids), *rest = self.best(unit, 2)
                loss = score - rest[0][0] if rest else np.inf
                self.kept.add([unit], np.array([score]), np.array([loss]), np.array([len(ids)]), np.array(ids))

    def solve(self, units: list[str], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Viterbi over the lattices of many units at once, forward and backward.

        The best path that takes an edge scores what lies ahead of it, itself and what lies behind;
        the second best path is the best one over an edge that is not on the best path.  Returns
        scores, losses of the second choice, numbers of ids, and all ids.
        """
        keys, targets, scores = self.table
        size = np.fromiter(map(len, units), np.int64, len(units))
        letters = np.frombuffer("".join([u.ljust(width, "\0") for u in units]).encode("utf-32-le"), "<u4").reshape(-1, width)
        codes = np.ascontiguousarray(letters.T).astype(np.uint64)
        codes = (codes + np.uint64(1)) * MIX
        rows, shape = np.arange(len(units)), (width + 1, len(units))
        ahead, behind = np.full(shape, -np.inf), np.full(shape, -np.inf)
        ahead[0], behind[size, rows] = 0, 0
        begin, piece = np.zeros(shape, np.int16), np.zeros(shape, np.int32)
        edges = []

        def relax(i: int, j: int, at: np.ndarray, ids: np.ndarray) -> None:
            gain = np.where(ids >= 0, scores[ids], self.floor)
            total = ahead[i][at] + gain
            better = total > ahead[j][at]
            to = at[better]
            ahead[j][to], begin[j][to], piece[j][to] = total[better], i, ids[better]
            edges.append((i, j, at, gain))

        for i in range(width):
            at = rows[size > i]
            key = np.zeros(len(at), np.uint64)
            for j in range(i + 1, width + 1):
                if not len(at):
                    break
                key = (key ^ codes[j - 1][at]) * MIX
                key ^= key >> np.uint64(31)
                place = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                known = keys[place] == key
                ids = np.where(known, targets[place], -1)
                if j == i + 1:
                    relax(i, j, at, ids)
                else:
                    whole = ids >= 0
                    if whole.any():
                        relax(i, j, at[whole], ids[whole])
                at, key = at[known], key[known]
                inside = size[at] > j
                at, key = at[inside], key[inside]
        for i, j, at, gain in reversed(edges):
            behind[i][at] = np.maximum(behind[i][at], gain + behind[j][at])
        path = np.full((width, len(units)), -2, np.int32)  # pieces by the place where they begin, -2 within one
        used = np.zeros(shape, np.int16)
        node, live = size.copy(), rows
        while len(live):
            before = begin[node[live], live].astype(np.int64)
            path[before, live] = piece[node[live], live]
            used[before, live] = node[live]
            node[live] = before
            live = live[before > 0]
        second = np.full(len(units), -np.inf)
        for i, j, at, gain in edges:
            through = ahead[i][at] + gain + behind[j][at]
            through[used[i][at] == j] = -np.inf
            second[at] = np.maximum(second[at], through)
        path = path.T
        odd = path == -1
        if not odd.any():
            return ahead[size, rows], ahead[size, rows] - second, (path >= 0).sum(axis=1), path[path >= 0]
        spell = {c: [self.bytes_first + b for b in chr(c).translate(SWAP).encode()] for c in np.unique(letters[odd]).tolist()}
        lengths = (path >= 0).astype(np.int64)
        lengths[odd] = [len(spell[c]) for c in letters[odd].tolist()]
        out = np.repeat(path.ravel(), lengths.ravel())
        out[out == -1] = list(chain.from_iterable([spell[c] for c in letters[odd].tolist()]))
        return ahead[size, rows], ahead[size, rows] - second, lengths.sum(axis=1), out

    @property
    def table(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sorted fingerprints of all prefixes of pieces, their ids, and the scores."""
        if "_table" not in self.__dict__:
            names = list(self.ids)
            keys = np.zeros(len(names), np.uint64)
            for k, name in enumerate(names):
                key = 0
                for c in name:
                    key = ((key ^ ((ord(c) + 1) * int(MIX) & WORD)) * int(MIX)) & WORD
                    key ^= key >> 31
                keys[k] = key
            order = np.argsort(keys)
            if (np.diff(keys[order]) == 0).any():
                raise ValueError("two prefixes of pieces have one fingerprint")
            ids = np.fromiter(self.ids.values(), np.int32, len(names))
            self._table = keys[order], ids[order], np.array(self.scores)
        return self._table

    def encode_all(self, texts: list[str], count: int = 1) -> Encoded:
        """The best segmentation of each text, and what the next ones change.

        A text's segmentations are one of each unit.  The best ones differ from the first in the
        units whose second choice costs least, so only ``count`` - 1 of these are combined, and only
        for them A* lists further ones.
        """
        parts = [self.units(SPACE + swapped(t)) if t else [] for t in texts]
        units = list(chain.from_iterable(parts))
        self.learn(set(units))
        kept, cuts = self.kept, np.concatenate([[0], np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)))])
        place = np.fromiter(map(kept.place.__getitem__, units), np.int64, len(units))
        sizes = kept.starts[place + 1] - kept.starts[place]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        ids = kept.ids[np.arange(ends[-1]) + np.repeat(kept.starts[place] - ends[:-1], sizes)]
        scores = np.add.reduceat(np.append(kept.score[place], 0.0), cuts[:-1]) * (np.diff(cuts) > 0) if len(texts) else np.zeros(0)
        losses, changes = kept.loss[place], [[] for _ in texts]
        for k, (s, e) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())) if count > 1 else ():
            own = losses[s:e]
            cheap = np.argpartition(own, count - 2)[: count - 1] if e - s >= count else np.arange(e - s)
            cheap = sorted(s + int(c) for c in cheap if own[c] < np.inf)
            choices = [self.others(units[c], count) for c in cheap]
            for loss, choice in combinations([[c[0][0] - o[0] for o in c] for c in choices], count)[1:]:
                edits = [(int(ends[c] - ends[s]), int(ends[c + 1] - ends[s]), o[m][1]) for c, o, m in zip(cheap, choices, choice) if m]
                changes[k].append((float(scores[k]) - loss, edits))
        return Encoded(ids, ends[cuts], scores, changes)

    @property
    def spelling(self) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all pieces in one row, and where each begins."""
        if "_spelling" not in self.__dict__:
            inside = range(self.bytes_first, self.bytes_first + 256)
            raw = [bytes([i - self.bytes_first]) if i in inside else p.replace(SPACE, " ").encode() for i, p in enumerate(self.pieces)]
            self._spelling = np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])
        return self._spelling

    def decode_all(self, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
        """The texts of lists of ids; bytes that are no UTF-8 become replacement marks."""
        data, begins = self.spelling
        sizes = begins[ids + 1] - begins[ids]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        out = data[np.arange(ends[-1]) + np.repeat(begins[ids] - ends[:-1], sizes)].tobytes()
        cuts = ends[offsets].tolist()
        return [out[s + (out[s : s + 1] == b" ") : e].decode("utf-8", "replace") if s < e else "" for s, e in zip(cuts, cuts[1:])]

    def decode(self, ids: list[int]) -> str:
        return self.decode_all(np.array(ids, np.int64), np.array([0, len(ids)]))[0]


@dataclass
class Encoded:
    """Ids of texts in one row with the offsets of each, scores, and replaced runs of ids by score."""

    ids: np.ndarray
    offsets: np.ndarray
    scores: np.ndarray
    changes: list[list[tuple[float, list[tuple[int, int, tuple[int, ...]]]]]]


def swapped(text: str) -> str:
    return text.translate(SWAP) if SPACE in text else text.replace(" ", SPACE)


def combinations(losses: list[list[float]], count: int) -> list[tuple[float, tuple[int, ...]]]:
    """The ``count`` choices of one entry of each list with the smallest sums; the lists rise from 0."""
    start = (0,) * len(losses)
    found, heap, seen = [], [(0.0, start)], {start}
    while heap and len(found) < count:
        loss, choice = heapq.heappop(heap)
        found.append((loss, choice))
        for x, own in enumerate(losses):
            more = (*choice[:x], choice[x] + 1, *choice[x + 1 :])
            if more[x] < len(own) and more not in seen:
                seen.add(more)
                heapq.heappush(heap, (loss - own[choice[x]] + own[more[x]], more))
    return found


def edited(ids: list[int], edits: list) -> list[int]:
    """A further segmentation from the best one's ids."""
    out, at = [], 0
    for begin, end, other in edits:
        out += [*ids[at:begin], *other]
        at = end
    return out + list(ids[at:])


ALTERNATIVES = "array<struct<score:double,edits:array<struct<begin:int,end:int,ids:array<int>>>>>"


def encode_pieces(
    docs: DataFrame, model: PieceModel, count: int = 1, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | tuple = (),
) -> DataFrame:
    """Piece ids of every text by the segmentation of the highest total score.

    One row for each input row: ``id_col``, ``text_col`` (null: empty), ``ids``, ``score``, and
    ``alternatives``: the next ``count`` - 1 segmentations (fewer, if there are no more) as score and
    the runs of ``ids`` that differ; ``carried`` if ``carry`` names columns.  A space before the text
    is part of its first piece; a character without piece costs ten more than the worst piece and is
    spelled in bytes, so every text decodes to itself.  An empty text has no pieces.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    texts = id_and_text(docs, id_col, text_col, carry)
    kind = pa.list_(pa.struct([("score", pa.float64()), ("edits", pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("ids", pa.list_(pa.int32()))])))]))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for batch in batches:
            for s in range(0, len(batch), 400):
                part = batch.slice(s, 400)
                made = own.encode_all(part.column("text").to_pylist(), count)
                lists = pa.ListArray.from_arrays(pa.array(made.offsets, pa.int32()), pa.array(made.ids))
                others = [[{"score": x, "edits": [{"begin": b, "end": e, "ids": i} for b, e, i in edits]} for x, edits in c] for c in made.changes]
                columns = [*part.columns, lists, pa.array(made.scores), pa.array(others, kind)]
                yield pa.RecordBatch.from_arrays(columns, [*part.schema.names, "ids", "score", "alternatives"])

    given = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in texts.schema)
    found = texts.mapInArrow(encode, f"{given}, ids array<int>, score double, alternatives {ALTERNATIVES}")
    return found.withColumnsRenamed({"id": id_col, "text": text_col}) if id_col != "id" or text_col != "text" else found


def decode_pieces(encoded: DataFrame, model: PieceModel, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``encoded`` with the text of ``ids_col`` (null: empty) as ``out_col``."""
    sent = encoded.sparkSession.sparkContext.broadcast(model)
    rest = [c for c in encoded.columns if c != out_col]

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in range(0, len(batch), 400):
                part = batch.slice(s, 400)
                lists = part.column(ids_col)
                sizes = pa.compute.fill_null(pa.compute.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
                ids = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                texts = sent.value.decode_all(ids, np.concatenate([[0], np.cumsum(sizes)]))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], [*part.schema.names, out_col])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.select(rest).schema)
    return encoded.select(rest).mapInArrow(decode, f"{schema}, `{out_col}` string")
