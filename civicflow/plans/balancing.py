"""Lines that balance: groups of a few lines whose amounts sum to zero in every measure.

Lines of a kind with one leader and the same amounts form a class, and only the first free line of a class can be the
next to be used. So what is searched are sets of classes, by meeting in the middle: sums of one, two or three classes
meet their negatives. Halves go to tasks by the residue of a linear checksum of their sums, so that a kind with many
classes is many tasks, each with bounded tables. What was found is then taken in order of its lines, in each set of
classes that found groups chain together.

Kinds of few lines need none of this: they pass through their task in order, thousands at once, and are searched there.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import chain
from math import factorial

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.chains import components
from ..state.lineage import cut

SIZES = range(2, 7)
#: Half sums that a task has in its table at once, about; and residues that it works on one after the other.
TABLE, RESIDUES = 1 << 21, 8
#: Lines of small chains that one task takes together, about.
LOT_LINES = 20_000
#: Lines that a task searches at once, about, where kinds have few.
PASS_LINES = 1 << 16


def _prime(least: int) -> int:
    """The first prime from least on; residues of sums of round amounts are spread by it."""
    n = max(least, 2)
    while any(n % d == 0 for d in range(2, int(n**0.5) + 1)):
        n += 1
    return n


def _ranges(sizes: np.ndarray) -> np.ndarray:
    total = np.cumsum(sizes)
    return np.arange(total[-1] if len(total) else 0) - np.repeat(total - sizes, sizes)


def _checks(amounts: np.ndarray) -> np.ndarray:
    """Linear checksums of the amounts. Modulo 2^64: sums wrap, and sets that balance come to zero."""
    return (amounts * np.random.default_rng(7).integers(1 << 40, 1 << 62, amounts.shape[1])).sum(axis=1)


def _meeting(sums: np.ndarray, want: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places in sums and in want of the same number, some TABLE of them at once."""
    order = np.argsort(sums)
    sums = sums[order]
    at = np.searchsorted(sums, want)
    count = np.searchsorted(sums, want, side="right") - at
    some = np.flatnonzero(count)
    bounds = np.searchsorted(np.cumsum(count[some]), np.arange(0, count.sum() + TABLE, TABLE))
    for a, b in zip(bounds, bounds[1:]):
        h = some[a:b] if b < len(some) else some[a:]
        yield order[np.repeat(at[h], count[h]) + _ranges(count[h])], np.repeat(h, count[h])


def _whole(one: np.ndarray, two: np.ndarray, leader: np.ndarray, amounts: np.ndarray) -> np.ndarray:
    """Sets of one and two together, where one comes first, all leaders differ and the amounts sum to zero."""
    ok = one[:, -1] < two[:, 0]
    for i in range(one.shape[1]):
        for j in range(two.shape[1]):
            ok &= leader[one[:, i]] != leader[two[:, j]]
    both = np.column_stack([one[ok], two[ok]])
    return both[~amounts[both].sum(axis=1).any(axis=1)]


class _Classes:
    """Sets of a kind's classes with different leaders, by place, with linear checksums of their amounts."""

    def __init__(self, leader: np.ndarray, amounts: np.ndarray, modulus: int):
        self.n, self.modulus, self.leader, self.amounts = len(leader), modulus, leader, amounts
        self.check = _checks(amounts)
        odd = np.random.default_rng(8).integers(1, max(modulus, 2), amounts.shape[1])
        self.residue = ((amounts % modulus) * odd % modulus).sum(axis=1) % modulus
        self.by_residue = np.argsort(self.residue, kind="stable")
        self.starts = np.searchsorted(self.residue[self.by_residue], np.arange(modulus + 1))

    def _longer(self, sets: np.ndarray, residue: int) -> np.ndarray:
        """sets, each with every later class of another leader that gives the whole this residue."""
        need = (residue - self.residue[sets].sum(axis=1)) % self.modulus
        start, count = self.starts[need], self.starts[need + 1] - self.starts[need]
        some = count > 0
        sets, start, count = sets[some], start[some], count[some]
        last = self.by_residue[np.repeat(start, count) + _ranges(count)]
        own = np.repeat(sets, count, axis=0)
        ok = last > own[:, -1]
        for k in range(own.shape[1]):
            ok &= self.leader[own[:, k]] != self.leader[last]
        return np.column_stack([own[ok], last[ok]])

    def sets(self, size: int, residue: int) -> np.ndarray:
        """All sets of one, two or three classes with this residue, a row each."""
        if size == 1:
            return np.flatnonzero(self.residue == residue)[:, None]
        if size == 2:
            return self._longer(np.arange(self.n)[:, None], residue)
        parts, first = [np.zeros((0, 3), np.int64)], 0
        a_pass = max(1, 2 * TABLE * self.modulus // max(self.n, self.modulus))
        while first < self.n:
            last = first + max(1, a_pass // (self.n - first))
            i = np.arange(first, min(last, self.n))
            later = self.n - 1 - i
            pairs = np.column_stack([np.repeat(i, later), np.repeat(i + 1, later) + _ranges(later)])
            pairs = pairs[self.leader[pairs[:, 0]] != self.leader[pairs[:, 1]]]
            parts.append(self._longer(pairs, residue))
            first = last
        return np.concatenate(parts)

    def balanced(self, low: np.ndarray, high: np.ndarray) -> Iterator[np.ndarray]:
        """low and high together where they sum to zero, low's classes come first and all leaders differ."""
        for one, two in _meeting(self.check[low].sum(axis=1), -self.check[high].sum(axis=1)):
            yield _whole(low[one], high[two], self.leader, self.amounts)


def balanced_sets(classes: DataFrame, size: int) -> DataFrame:
    """kind, cids of all sets of so many classes (kind, cid, leader, amounts) of a kind that balance, leaders all different."""
    low, high = size // 2, size - size // 2
    listed = classes.groupBy("kind").agg(F.array_sort(F.collect_list(F.struct("cid", "leader", "amounts"))).alias("c")).where(F.size("c") >= size)
    n = F.size("c").cast("double")
    halves = {1: n, 2: n * n / 2, 3: n * n * n / 6}[high]
    lots = F.greatest(F.lit(1), F.ceil(halves / (TABLE * RESIDUES))).cast("int")
    dealt = listed.withColumn("lots", lots).withColumn("lot", F.explode(F.sequence(F.lit(0), F.col("lots") - 1)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for kind, listed, lots, lot in zip(*(b.column(x) for x in ("kind", "c", "lots", "lot"))):
                lots, lot = lots.as_py(), lot.as_py()
                cid, leader = (listed.values.field(x).to_numpy() for x in ("cid", "leader"))
                amounts = listed.values.field("amounts").flatten().to_numpy().reshape(len(cid), -1)
                few = len(cid) ** high <= TABLE
                own = _Classes(leader, amounts, 1 if few else _prime(lots * RESIDUES))
                for residue in range(lot, own.modulus, lots):
                    other = -residue % own.modulus
                    if low == high and other < residue:
                        continue  # was met from the other side
                    one, two = own.sets(low, residue), own.sets(high, other)
                    for x, y in [(one, two), (two, one)] if low == high and other != residue else [(one, two)]:
                        for found in own.balanced(x, y):
                            if len(found):
                                sets = pa.ListArray.from_arrays(pa.array(np.arange(len(found) + 1) * size, pa.int32()), pa.array(cid[found].ravel()))
                                yield pa.RecordBatch.from_arrays([pa.array([kind.as_py()] * len(found), pa.string()), sets], names=["kind", "cids"])

    return dealt.repartition(F.xxhash64("kind", "lot")).mapInArrow(run, "kind string, cids array<long>")


def take_in_order(lines: pd.DataFrame, sets: pd.DataFrame) -> pd.DataFrame:
    """line, first of the lines (line, idx, cid) in groups: each free line in order begins the least group that it can.

    Groups compare by their lines' idx in rising order. Of a class only its first free line after the group's first can
    be in the least group, so one look at the heads of the classes finds it. Chains that share no class may come
    together: what one takes is nothing to the others.
    """
    lines = lines.sort_values("idx", kind="stable")
    cids, of = np.unique(lines["cid"].to_numpy(), return_inverse=True)
    line = lines["line"].to_numpy()
    rows = np.split(np.argsort(of, kind="stable"), np.cumsum(np.bincount(of))[:-1])
    places = np.searchsorted(cids, np.stack(sets["cids"].to_numpy()))
    size = places.shape[1]
    flat = places.ravel()
    by_class = np.argsort(flat, kind="stable")
    starts = np.searchsorted(flat[by_class], np.arange(len(cids) + 1))
    others: dict[int, np.ndarray] = {}
    none = len(line)
    heads = np.append([r[0] for r in rows], none)
    next_, used = np.ones(len(cids), np.int64), np.zeros(len(line), bool)
    out: list[tuple[int, int]] = []

    def step(c: int) -> None:
        heads[c] = rows[c][next_[c]] if next_[c] < len(rows[c]) else none
        next_[c] += 1

    for k, c in enumerate(of.tolist()):
        if used[k]:
            continue
        step(c)  # later groups begin later, so this line is no one's partner any more
        if c not in others:
            having = places[by_class[starts[c] : starts[c + 1]] // size]
            others[c] = having[having != c].reshape(-1, size - 1)
        ahead = np.sort(heads[others[c]], axis=1)
        ahead = ahead[ahead[:, -1] < none]
        if len(ahead):
            best = ahead[np.lexsort(ahead.T[::-1])[0]] if len(ahead) > 1 else ahead[0]
            used[best] = True
            for m in best.tolist():
                step(int(of[m]))
            out += [(line[m], line[k]) for m in (k, *best.tolist())]
    return pd.DataFrame(out, columns=["line", "first"]).astype("int64")


def balanced_groups(lines: DataFrame, sizes: Sequence[int] = SIZES) -> DataFrame:
    """line, first of all lines that are in a group; first is the group's first line.

    lines: line (a unique number), kind (text), idx (its place in the kind), leader (a number), amounts (whole numbers,
    one for each measure, not all zero). Groups are of lines of one kind with different leaders that sum to zero in each
    measure. Small sizes come first; of a size, each free line in order begins the group whose other lines come first.

    Half of a group's classes is enumerated: 5,000 classes of a kind give 2 * 10^10 sets of three, which residues spread
    over some 1,000 tasks. Lines of equal amounts and leader cost nothing more. What chained groups share is taken in
    order in one task: narrow rows, linear in lines and found sets.
    """
    free, taken = lines, []
    rows = lines.count()
    for size in sizes:
        classes = free.groupBy("kind", "leader", "amounts").agg(F.min("line").alias("cid"))
        sets = cut(balanced_sets(classes, size))
        if sets.isEmpty():
            continue
        found = components(sets.select(F.col("cids")[0].alias("a"), F.explode(F.slice("cids", 2, size - 1)).alias("b")))
        chained = classes.join(found, classes["cid"] == found["node"]).select("kind", "leader", "amounts", "cid", "root")
        lot = F.pmod(F.xxhash64("root"), F.lit(max(64, rows // LOT_LINES)))  # small chains come together
        own = free.join(chained, ["kind", "leader", "amounts"]).select(lot.alias("a"), "line", "idx", "cid")
        groups = sets.join(found, F.col("cids")[0] == F.col("node")).select(lot.alias("b"), "cids")
        taken.append(cut(own.groupBy("a").cogroup(groups.groupBy("b")).applyInPandas(take_in_order, "line long, first long"), rows))
        free = cut(free.join(taken[-1], "line", "left_anti"), rows)
    out = lines.sparkSession.createDataFrame([], "line long, first long")
    for t in taken:
        out = out.unionByName(t)
    return out


def few_lines() -> int:
    """The most lines of a kind that is searched as it passes; pairs of their sets of three that meet are some TABLE."""
    return int(TABLE**0.25)


class _Kinds:
    """Lines of many kinds of few, in order: kind (a number, rising), leader, amounts."""

    def __init__(self, kind: np.ndarray, leader: np.ndarray, amounts: np.ndarray):
        self.kind, self.leader, self.amounts, self.check = kind, leader, amounts, _checks(amounts)
        new = np.flatnonzero(np.diff(kind, prepend=-1))
        self.n = np.diff(new, append=len(kind))
        self.start = np.repeat(new, self.n)
        self.end = np.repeat(new + self.n, self.n)

    def _sets(self, size: int, before: int, after: int) -> np.ndarray:
        """Sets of so many of a kind's lines with different leaders, a row each, that leave lines before and after them."""
        place = np.arange(len(self.kind))
        sets = place[(place >= self.start + before) & (place < self.end - after - size + 1)][:, None]
        for left in range(size - 2, -1, -1):
            last = sets[:, -1]
            later = np.maximum(self.end[last] - after - left - last - 1, 0)
            own, one = np.repeat(sets, later, axis=0), np.repeat(last + 1, later) + _ranges(later)
            ok = np.ones(len(one), bool)
            for k in range(own.shape[1]):
                ok &= self.leader[own[:, k]] != self.leader[one]
            sets = np.column_stack([own[ok], one[ok]])
        return sets

    def groups(self, size: int) -> np.ndarray:
        """The groups of so many lines, a row each: in each kind the first one in order, then the first of what it leaves."""
        a, b = size // 2, size - size // 2
        mark = self.kind * np.int64(0x5851F42D4C957F2D)  # wraps; halves of other kinds do not meet
        low, high = self._sets(a, 0, b), self._sets(b, a, 0)
        found = [np.zeros((0, size), np.int64)]
        for one, two in _meeting(self.check[low].sum(axis=1) + mark[low[:, 0]], mark[high[:, 0]] - self.check[high].sum(axis=1)):
            same = self.kind[low[one, 0]] == self.kind[high[two, 0]]
            found.append(_whole(low[one[same]], high[two[same]], self.leader, self.amounts))
        sets = np.concatenate(found)
        sets, out = sets[np.lexsort(sets.T[::-1])], [np.zeros((0, size), np.int64)]
        used = np.zeros(len(self.kind), bool)
        while len(sets):
            out.append(sets[np.diff(self.kind[sets[:, 0]], prepend=-1) != 0])
            used[out[-1]] = True
            sets = sets[~used[sets].any(axis=1)]
        return np.concatenate(out)


def first_lines(kind: np.ndarray, leader: np.ndarray, amounts: np.ndarray, sizes: Sequence[int] = SIZES) -> np.ndarray:
    """For each line (kind: a number, rising; in order) the place of the first line of its group, or its own."""
    first, free = np.arange(len(kind)), amounts.any(axis=1)
    for size in sizes:
        lines = np.flatnonzero(free)
        n = np.diff(np.flatnonzero(np.diff(kind[lines], prepend=-1)), append=len(lines))
        lines, n = lines[np.repeat(n >= size, n)], n[n >= size]
        passes = np.cumsum(n.astype(float) ** size / factorial(size)) // TABLE  # kinds may balance in all ways
        for own in np.split(lines, np.cumsum(n)[:-1][np.diff(passes) > 0]):
            groups = own[_Kinds(kind[own], leader[own], amounts[own]).groups(size)]
            first[groups] = groups[:, :1]
            free[groups] = False
    return first


def groups_of_few(lines: DataFrame, order: Sequence[str], carried: Sequence[str], sizes: Sequence[int] = SIZES) -> DataFrame:
    """group, an array of structs of carried, of each balanced group and of each line that is in none.

    lines: kind (text), leader (a number), amounts (whole numbers, one for each measure), carried, and order, which gives
    each line's place in its kind; at most few_lines() of a kind have amounts that are not all zero. Groups are those of
    balanced_groups. A kind's lines come to one task one after the other, and some thousand kinds are searched at once.
    """
    names = ["kind", "leader", "amounts", *carried]
    dealt = lines.withColumn("bucket", F.xxhash64("kind")).repartition("bucket")  # numbers sort faster than texts
    rows = dealt.sortWithinPartitions("bucket", "kind", *order).select(*names)
    fields = [f for f in rows.schema.fields if f.name in carried]
    made = "group array<struct<" + ",".join(f"{f.name}:{f.dataType.simpleString()}" for f in fields) + ">>"

    def search(t: pa.Table, kind: np.ndarray) -> pa.RecordBatch:
        flat = t.column("amounts").combine_chunks().flatten().to_numpy()
        first = first_lines(kind, t.column("leader").to_numpy(), flat.reshape(len(kind), -1), sizes)
        by_group = np.argsort(first, kind="stable")
        starts = np.flatnonzero(np.diff(first[by_group], prepend=-1, append=len(kind)))
        items = t.select(carried).take(pa.array(by_group)).combine_chunks()
        structs = pa.StructArray.from_arrays([items.column(c).combine_chunks() for c in carried], list(carried))
        return pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array(starts, pa.int32()), structs)], names=["group"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for b in chain(batches, [None]):
            held += [b] if b is not None and b.num_rows else []
            if not held or (b is not None and sum(x.num_rows for x in held) < PASS_LINES):
                continue
            t = pa.Table.from_batches(held).combine_chunks()
            names = t.column("kind").combine_chunks()
            kind = np.cumsum(np.append(False, pc.not_equal(names[1:], names[:-1]).to_numpy(zero_copy_only=False)))
            whole = t.num_rows if b is None else int(np.searchsorted(kind, kind[-1]))  # the last kind may go on
            held = t.slice(whole).to_batches()
            if whole:
                yield search(t.slice(0, whole), kind[:whole])

    return rows.mapInArrow(run, made)
