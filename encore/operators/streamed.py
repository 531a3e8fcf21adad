"""Best candidates of blocks of queries, the candidates read once in a stream.

A group is one block of queries and the candidates that it meets; its rows come
sorted: queries first, then candidates by cell. A task holds the block of
queries, their lists so far, one Arrow batch of candidates and some tiles, so a
group may have any number of candidates and blocks of queries can be large: the
fewer there are, the fewer copies of the candidates are shuffled.

A tile is multiplied in single precision first. Only pairs that reach the last
similarity of a list, less the error that such a product can have, are
computed in doubles, rounded and ranked, so the lists are those of doubles alone.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from encore.operators.similar import _NO_SCORE, _round_micro

SCORED_SCHEMA = "track_id long, similar_track_id long, sim_micro long, similar_label int"
#: Bytes of a block of queries, as doubles.
QUERY_BYTES = 1 << 26
#: Pairs of a tile, candidates of a tile, and pairs computed in doubles at once.
_TILE, _CANDS, _PAIRS = 1 << 20, 512, 1 << 14
#: A tile of which a larger part passes is multiplied in doubles too.
_MANY = 1 / 16
_NO_LABEL = np.iinfo(np.int64).min
_NO_ID = np.iinfo(np.int64).max
_OUT_ROWS = 1 << 16


def rows_of_vectors(column) -> np.ndarray:
    """A matrix of a column of arrays, which must have one length."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    ends = column.offsets.to_numpy()
    if len(column) and (np.diff(ends) != ends[1] - ends[0]).any():
        raise ValueError("vectors differ in length")
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


class _Vectors:
    """Ids, vectors, norms and single-precision unit vectors of some rows."""

    def __init__(self, ids: np.ndarray, mat: np.ndarray):
        self.ids, self.mat = ids, mat
        wide = mat.astype(np.float64, copy=False)
        self.norm = np.linalg.norm(wide, axis=1)
        with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
            self.unit = (wide / self.norm[:, None]).astype(np.float32)


class _Lists:
    """The best candidates so far of one group's queries."""

    def __init__(self, group: int, k: int, room: np.ndarray):
        self.group, self.k, self.room = group, k, room
        self.parts: list[tuple] = []
        self.queries: _Vectors | None = None

    def ask(self, batch) -> None:
        """Queries, sorted by track, with the cells that they ask as bits, or none if they ask all."""
        bits = batch.column("bits")
        held = [np.frombuffer(b, np.uint8) for b in bits.to_pylist()] if bits.null_count == 0 else None
        self.parts.append((batch.column("track_id").to_numpy(), rows_of_vectors(batch.column("features")).copy(),
                           None if held is None else np.stack(held)))

    def _ready(self) -> bool:
        if self.queries is None and self.parts:
            ids, mats, bits = zip(*self.parts)
            self.parts = []
            self.queries = _Vectors(np.concatenate(ids), np.concatenate(mats))
            self.bits = None if bits[0] is None else np.ascontiguousarray(np.concatenate(bits).T)
            n = len(self.queries.ids)
            self.micro = np.full((n, self.k), _NO_SCORE, np.int64)
            self.found = np.full((n, self.k), _NO_ID, np.int64)
            self.label = np.full((n, self.k), _NO_LABEL, np.int64)
            self.floor = np.full(n, -np.inf)
        return self.queries is not None

    def meet(self, batch) -> None:
        """Candidates, sorted by cell."""
        if not self._ready():
            return
        cell = batch.column("cell").to_numpy()
        label = batch.column("label").cast(pa.int64()).fill_null(_NO_LABEL).to_numpy()
        cands = _Vectors(batch.column("track_id").to_numpy(), rows_of_vectors(batch.column("features")))
        if cands.mat.shape[1] != self.queries.mat.shape[1]:
            raise ValueError("vectors differ in length")
        q = self.queries
        # products of norms that doubles can't hold leave pairs without a similarity
        self.plain = bool(q.norm.max() * cands.norm.max() < 1e300 and q.norm.min() * cands.norm.min() > 1e-290)
        at = np.minimum(np.searchsorted(q.ids, cands.ids), len(q.ids) - 1)
        own = np.where(q.ids[at] == cands.ids, at, -1)
        cuts = np.flatnonzero(cell[1:] != cell[:-1]) + 1
        for lo, hi in zip(np.r_[0, cuts], np.r_[cuts, len(cell)]):
            who = None
            if self.bits is not None:
                who = np.flatnonzero(self.bits[cell[lo] >> 3] >> (cell[lo] & 7) & 1)
            n = len(q.ids) if who is None else len(who)
            for c in range(lo, hi, _CANDS):
                c = slice(c, min(c + _CANDS, hi))
                step = max(1, _TILE // (c.stop - c.start))
                for at in range(0, n, step):
                    part = slice(at, min(at + step, n))
                    self._tile(part if who is None else who[part], cands, c, own[c], label[c])

    def _tile(self, who, cands: _Vectors, c: slice, own: np.ndarray, label: np.ndarray) -> None:
        """``who``: queries, a slice or ascending places."""
        q, floor = self.queries, self.floor[who]
        ids = cands.ids[c]
        shape = (len(floor), len(ids))
        mine = np.flatnonzero(own >= 0)
        if isinstance(who, slice):
            rows = own[mine] - who.start
            met = (rows >= 0) & (rows < shape[0])
        else:
            rows = np.searchsorted(who, own[mine])
            met = who[np.minimum(rows, shape[0] - 1)] == own[mine]
        selves = rows[met], mine[met]
        hits = None
        if self.plain:
            sim = self.room[:shape[0] * shape[1]].reshape(shape)
            np.matmul(q.unit[who], cands.unit[c].T, out=sim)
            sim[selves] = -np.inf
            # what the product of two unit vectors may lack, rounded terms and sums, twice
            error = (q.mat.shape[1] + 8) * 2.0 ** -23
            low = floor - error
            if shape[1] > self.k and np.isneginf(floor).any():
                low = np.maximum(low, np.partition(sim, shape[1] - self.k, axis=1)[:, -self.k] - 2 * error - 2e-6)
            hits = np.flatnonzero(sim >= low.astype(np.float32)[:, None])
        if hits is None or len(hits) > _MANY * shape[0] * shape[1]:
            hits = self._in_doubles(who, cands, c, selves, floor, ids)
        if not len(hits):
            return
        rows, columns = np.divmod(hits, shape[1])
        places = rows + who.start if isinstance(who, slice) else who[rows]
        micro = np.empty(len(rows), np.int64)
        valid = np.empty(len(rows), bool)
        for s in range(0, len(rows), _PAIRS):
            s = slice(s, s + _PAIRS)
            p, j = places[s], c.start + columns[s]
            with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
                den = q.norm[p] * cands.norm[j]
                # of one pair always the same, whichever tile it stands in
                value = (q.mat[p].astype(np.float64, copy=False) * cands.mat[j].astype(np.float64, copy=False)).sum(axis=1) / den
            valid[s] = np.isfinite(value) & (den > 0)
            micro[s] = _round_micro(np.where(valid[s], value, 0.0))
        self._enter(places[valid], micro[valid], ids[columns[valid]], label[columns[valid]])

    def _in_doubles(self, who, cands: _Vectors, c: slice, selves, floor: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Places in the tile of the pairs that may enter a list, equal similarities by their ids."""
        q = self.queries
        with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
            den = np.outer(q.norm[who], cands.norm[c])
            sim = (q.mat[who].astype(np.float64, copy=False) @ cands.mat[c].astype(np.float64, copy=False).T) / den
        sim[~(np.isfinite(sim) & (den > 0))] = -np.inf
        sim[selves] = -np.inf
        last, last_id = self.micro[who, -1], self.found[who, -1]
        none = np.isneginf(floor)
        least = np.where(none, -np.inf, (last - 0.5) * 1e-6 - 1e-9)
        above = np.where(none, -np.inf, (last + 0.5) * 1e-6 - 1e-9)
        if sim.shape[1] > self.k and none.any():
            kth = np.partition(sim, sim.shape[1] - self.k, axis=1)[:, -self.k]
            least, above = np.maximum(least, kth - 2e-6), np.where(none, kth - 2e-6, above)
        enters = (sim >= above[:, None]) | ((sim >= least[:, None]) & (ids < last_id[:, None]))
        return np.flatnonzero(enters & ~np.isneginf(sim))

    def _enter(self, rows: np.ndarray, micro: np.ndarray, ids: np.ndarray, label: np.ndarray) -> None:
        """Take pairs, in order of their rows, into the lists: the larger similarity, then the smaller id, each id once."""
        if not len(rows):
            return
        own, first, n = np.unique(rows, return_index=True, return_counts=True)
        place = np.repeat(np.arange(len(own)), n), self.k + np.arange(len(rows)) - np.repeat(first, n)
        width = self.k + n.max()
        both = []
        for kept, new, none in ((self.micro, micro, _NO_SCORE), (self.found, ids, _NO_ID), (self.label, label, _NO_LABEL)):
            wide = np.full((len(own), width), none, np.int64)
            wide[:, :self.k] = kept[own]
            wide[place] = new
            both.append(wide)
        both = self._sorted(both)
        again = (both[1][:, 1:] == both[1][:, :-1]) & (both[0][:, 1:] == both[0][:, :-1]) & (both[0][:, 1:] != _NO_SCORE)
        if again.any():
            for wide, none in zip(both, (_NO_SCORE, _NO_ID, _NO_LABEL)):
                wide[:, 1:][again] = none
            both = self._sorted(both)
        for kept, wide in zip((self.micro, self.found, self.label), both):
            kept[own] = wide[:, :self.k]
        last = self.micro[own, -1]
        # a millionth less, so that what rounds to the last similarity is not left out
        self.floor[own] = np.where(last == _NO_SCORE, -np.inf, (last - 1) * 1e-6)

    @staticmethod
    def _sorted(both: list[np.ndarray]) -> list[np.ndarray]:
        order = np.lexsort((both[1], -both[0]), axis=-1)
        return [np.take_along_axis(wide, order, axis=1) for wide in both]

    def rows(self):
        """The lists, a batch at a time."""
        if self.queries is None:
            return
        step = max(1, _OUT_ROWS // self.k)
        for at in range(0, len(self.floor), step):
            s = slice(at, at + step)
            r, j = np.nonzero(self.micro[s] != _NO_SCORE)
            label = self.label[s][r, j]
            yield pa.RecordBatch.from_arrays(
                [pa.array(self.queries.ids[s][r]), pa.array(self.found[s][r, j]), pa.array(self.micro[s][r, j]),
                 pa.array(np.where(label == _NO_LABEL, 0, label).astype(np.int32), mask=label == _NO_LABEL)],
                ["track_id", "similar_track_id", "sim_micro", "similar_label"])


def streamed_lists(k: int):
    """mapInArrow function: rows (grp, side, cell, bits, track_id, features, label) sorted by grp, side, cell and track,
    side 0 queries and 1 candidates -> each query's ``k`` best in its group."""
    def run(batches):
        lists, room = None, np.empty(_TILE, np.float32)
        for batch in batches:
            if not batch.num_rows:
                continue
            key = 2 * batch.column("grp").to_numpy().astype(np.int64) + batch.column("side").to_numpy()
            cuts = np.flatnonzero(key[1:] != key[:-1]) + 1
            for lo, hi in zip(np.r_[0, cuts], np.r_[cuts, len(key)]):
                group, side = divmod(int(key[lo]), 2)
                if lists is None or lists.group != group:
                    if lists is not None:
                        yield from lists.rows()
                    lists = _Lists(group, k, room)
                (lists.meet if side else lists.ask)(batch.slice(lo, hi - lo))
        if lists is not None:
            yield from lists.rows()
    return run
