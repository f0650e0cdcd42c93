"""Near-duplicate search in three steps shared by several operators.

1. ``live_buckets``: from (key, uid) rows keep the keys that two or more different
   uids share; of keys with the same members one is enough.
2. ``links``: within each bucket, verify exact Jaccard and link what reaches the
   threshold. A bucket too large for one task is dealt to several, each of which
   also gets the bucket's first member; what is not linked to that member's group
   meets all parts of the bucket in a second pass. So no link is lost, no task
   holds more than a bounded part of a bucket, and only a spanning set of links,
   never all pairs, is emitted.
3. ``components.connected_components`` joins the links up.

A uid stands for a distinct text; exact copies share it and cost nothing here.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, discard, lean, materialise
from .textkernel import mix

#: Bytes of sets that one task takes of one bucket.
PART_BYTES = 8_000_000
#: Members of one bucket that one task takes.
PART_ROWS = 4_000
#: Bytes of sets that a task compares at once, if their groups are smaller.
CHUNK_BYTES = 1_000_000
#: Rows of a few integers that a broadcast may hold (about 100 MB of them in memory);
#: beyond it the join is shuffled.
BROADCAST_ROWS = 2_000_000
#: The same for rows with arrays or blobs: bytes in all.
BROADCAST_BYTES = 64_000_000


def bounded(df: DataFrame, size=None) -> DataFrame:
    """``df`` with a broadcast hint if it is surely small.

    Rows of a few integers are counted against BROADCAST_ROWS. For others ``size``
    is a column with a row's bytes, whose sum is held against BROADCAST_BYTES.
    """
    if size is None:
        return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df
    total = df.agg(F.coalesce(F.sum(size + 64), F.lit(0))).first()[0]
    return F.broadcast(df) if total <= BROADCAST_BYTES else df


def live_buckets(keys: DataFrame) -> DataFrame:
    """(key, uid) rows of the buckets worth verifying, from (key, uid) rows.

    Aggregated per key before the shuffle; keys whose members are the same set are
    reduced to one.
    """
    live = keys.groupBy("key").agg(F.min("uid").alias("lo"), F.max("uid").alias("hi")).where("lo < hi").select("key")
    live = materialise(live, "live")
    rows = materialise(keys.join(bounded(live), "key", "left_semi").distinct(), "members")
    same = rows.groupBy("key").agg(F.count(F.lit(1)).alias("m"), F.bit_xor(F.xxhash64("uid")).alias("x"), F.min("uid").alias("lo"))
    one = same.groupBy("m", "x", "lo").agg(F.min("key").alias("key")).select("key")
    out = materialise(rows.join(one, "key", "left_semi"), "buckets")
    discard(live, rows)
    return out


def ranges(first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All of first[i] .. first[i]+count[i]-1 end to end, and where each i begins."""
    cut = np.concatenate(([0], np.cumsum(count)))
    return np.repeat(first - cut[:-1], count) + np.arange(cut[-1]), cut


def stable_order(key: np.ndarray) -> np.ndarray:
    """``np.argsort(key, kind="stable")``, by sorting the keys' upper bits with the places in the lower ones."""
    bits = np.uint64(max(len(key) - 1, 1).bit_length())
    packed = np.sort((key >> bits << bits) | np.arange(len(key), dtype=np.uint64))
    order = (packed & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    k = key[order]
    # Different keys with the same upper bits are rare, unless there are many keys.
    return np.argsort(key, kind="stable") if (k[1:] < k[:-1]).any() else order


class Members:
    """Members of many groups at once, each a set of 64-bit values.

    ``values`` are the members' values end to end (repeats within a member count
    once), ``count`` how many each has, ``group`` the ascending group of each. Values
    become numbers that are equal for equal values of the same group.
    """

    def __init__(self, values: np.ndarray, count: np.ndarray, group: np.ndarray):
        self.group = group
        of = np.repeat(np.arange(len(count)), count)
        # Equal values of a group have the same 64-bit key; equal keys stay in order, so a member's repeats are together.
        key = mix(values ^ np.repeat(mix(group.astype(np.uint64) + np.uint64(1)), count))
        order = stable_order(key)
        k, v, om = key[order], values[order], of[order]
        new = np.ones(len(v), bool)
        new[1:] = (k[1:] != k[:-1]) | (v[1:] != v[:-1])  # the same key and value: the same group
        fresh = new.copy()
        fresh[1:] |= om[1:] != om[:-1]
        ids, keep = np.empty(len(v), np.int64), np.empty(len(v), bool)
        ids[order], keep[order] = np.cumsum(new) - 1, fresh
        self.ids, self.mark = ids[keep], np.zeros(len(v) + 1, bool)
        self.size = np.bincount(of[keep], minlength=len(count))
        self.at = np.concatenate(([0], np.cumsum(self.size)))

    def near(self, pivots: np.ndarray, p: np.ndarray, q: np.ndarray, threshold: float) -> np.ndarray:
        """Whether each q[i] reaches the threshold with p[i]; ``pivots`` are the p, one a group."""
        a, b = self.size[p], self.size[q]
        out = (a >= threshold * b - 1e-9) & (b >= threshold * a - 1e-9)
        some = np.flatnonzero(out)
        if len(some):
            marked = self.ids[ranges(self.at[pivots], self.size[pivots])[0]]
            self.mark[marked] = True
            at, cut = ranges(self.at[q[some]], b[some])
            total = np.concatenate(([0], np.cumsum(self.mark[self.ids[at]])))
            self.mark[marked] = False
            both = total[cut[1:]] - total[cut[:-1]]
            out[some] = both >= threshold * (a[some] + b[some] - both) - 1e-9
        return out

    def spanning_links(self, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Links (a, b) that connect what all verified pairs would, and each member's component.

        In each round one member of every group is compared with those of its group
        that no component has taken yet: a linked one that wasn't compared so far, or
        else the first that is open.
        """
        n = len(self.group)
        component, links = np.full(n, -1), [(np.zeros(0, np.int64),) * 2]
        rest, wait = np.arange(n), np.zeros(0, np.int64)
        while len(rest):
            g = self.group[rest]
            first = np.flatnonzero(np.diff(g, prepend=g[0] - 1))
            open_ = g[first]
            wait = wait[np.isin(self.group[wait], open_)]
            at = np.searchsorted(self.group[wait], open_)
            has = at < len(wait)
            has[has] = self.group[wait[at[has]]] == open_[has]
            pivot = rest[first]
            component[pivot[~has]] = pivot[~has]
            pivot[has] = wait[at[has]]
            wait, rest = np.delete(wait, at[has]), np.delete(rest, first[~has])
            if not len(rest):
                break
            p = pivot[np.searchsorted(open_, self.group[rest])]
            hit = self.near(pivot, p, rest, threshold)
            component[rest[hit]] = component[p[hit]]
            links.append((p[hit], rest[hit]))
            wait = np.sort(np.concatenate((wait, rest[hit])))
            rest = rest[~hit]
        return *(np.concatenate(x) for x in zip(*links, strict=True)), component


class Sets:
    """Members of one part of a bucket: sorted sets laid end to end."""

    def __init__(self, values: np.ndarray, count: np.ndarray):
        m = Members(values, count, np.zeros(len(count), np.int64))
        self.size, self.ids, self.at = m.size, m.ids, m.at
        self.v = len(m.mark)

    def shared(self, p: int, among: np.ndarray, flat: np.ndarray, cut: np.ndarray) -> np.ndarray:
        """How many values member ``p`` shares with each of ``among``."""
        mark = np.zeros(self.v + 1, np.int32)
        mark[self.ids[self.at[p] : self.at[p + 1]]] = 1
        total = np.concatenate(([0], np.cumsum(mark[flat])))
        return total[cut[1:]] - total[cut[:-1]]

    def flat(self, among: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cut = np.concatenate(([0], np.cumsum(self.size[among])))
        parts = [self.ids[self.at[i] : self.at[i + 1]] for i in among]
        return (np.concatenate(parts) if parts else np.zeros(0, np.int64)), cut

    def near(self, p: int, among: np.ndarray, flat, cut, threshold: float) -> np.ndarray:
        both = self.shared(p, among, flat, cut)
        union = self.size[p] + self.size[among] - both
        return both >= threshold * union - 1e-9


def groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Runs of rows that agree in their first ``keys`` columns, from sorted batches."""
    held: list[pa.Table] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        t = pa.Table.from_batches([batch])
        cols = [t.column(i).to_numpy() for i in range(keys)]
        new = np.zeros(t.num_rows, bool)
        for c in cols:
            new[1:] |= c[1:] != c[:-1]
        new[0] = last is not None and any(c[0] != v for c, v in zip(cols, last, strict=True))
        cuts = [0, *np.flatnonzero(new).tolist(), t.num_rows] if not new[0] else [*np.flatnonzero(new).tolist(), t.num_rows]
        if new[0]:
            yield pa.concat_tables(held)
            held = []
        for i, (x, y) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            if i and held:
                yield pa.concat_tables(held)
                held = []
            held.append(t.slice(x, y - x))
        last = [c[-1] for c in cols]
    if held:
        yield pa.concat_tables(held)


def by_group(df: DataFrame, keys: list[str], f, schema: str) -> DataFrame:
    """Apply ``f`` (table to tables) to each group; many small groups cost little."""
    rest = [c for c in df.columns if c not in keys]
    placed = df.select(*keys, *rest).repartition(*keys).sortWithinPartitions(*keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending, rows = [], 0
        for t in groups(batches, len(keys)):
            out = f(t)
            if out is not None and out.num_rows:
                pending.append(out)
                rows += out.num_rows
            if rows >= 10_000:
                yield from pa.concat_tables(pending).combine_chunks().to_batches()
                pending, rows = [], 0
        if pending:
            yield from pa.concat_tables(pending).combine_chunks().to_batches()

    return placed.mapInArrow(lean(run), schema)


def _starts(t: pa.Table, keys: int) -> np.ndarray:
    """Where the runs of rows that agree in the first ``keys`` columns begin."""
    new = np.zeros(t.num_rows, bool)
    new[:1] = True
    for i in range(keys):
        c = t.column(i).to_numpy()
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def many_groups(batches: Iterator[pa.RecordBatch], keys: int, weight: int, limit: int) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups and where each begins, cut where binary column ``weight`` passes ``limit`` bytes.

    Rows come sorted by the first ``keys`` columns. A group larger than the limit is a table by itself.
    """
    held, total = [], 0

    def cut(t: pa.Table, last: bool):
        size = pc.binary_length(t.column(weight)).to_numpy()
        before = np.concatenate(([0], np.cumsum(size)))
        starts = _starts(t, keys)
        ends = [*starts[1:].tolist(), t.num_rows] if last else starts[1:].tolist()
        done = i = 0
        while i < len(ends):
            # As many groups as the limit takes, one at least.
            j = max(int(np.searchsorted(before[ends], before[done] + limit, "right")), i + 1)
            yield t.slice(done, ends[j - 1] - done).combine_chunks(), starts[i:j] - done
            done, i = ends[j - 1], j
        held[:] = [t.slice(done)] if done < t.num_rows else []
        return before[-1] - before[done]

    for batch in batches:
        if batch.num_rows:
            held.append(pa.Table.from_batches([batch]))
            total += batch.nbytes
            if total > limit:
                total = yield from cut(pa.concat_tables(held), False)
    if held:
        yield from cut(pa.concat_tables(held), True)


def _first_of_each(t: pa.Table) -> pa.Table:
    """One row per uid, in uid order."""
    uids = t.column("uid").to_numpy()
    return t.take(pa.array(np.unique(uids, return_index=True)[1]))


BITS = 1024


def bitmap(values: np.ndarray) -> bytes:
    """Which of BITS slots a set's values fall into."""
    flags = np.zeros(BITS, bool)
    flags[(values >> np.uint64(20)) & np.uint64(BITS - 1)] = True
    return np.packbits(flags).tobytes()


def prune(buckets: DataFrame, sketches: DataFrame, threshold: float) -> DataFrame:
    """Drop members of a bucket that can't reach the threshold with any other member.

    ``sketches`` has (uid, n, bits). A value whose slot the other set leaves empty is
    surely not shared, so a count of such slots bounds the similarity from above and
    no link is lost. Buckets of more than PART_ROWS members pass as they are.
    """
    sized = materialise(buckets.groupBy("key").agg(F.count(F.lit(1)).alias("m")), "counts")
    fit = buckets.join(sized.where(F.col("m") <= PART_ROWS).select("key"), "key", "left_semi").join(sketches, "uid").select("key", "uid", "n", "bits")

    def survivors(t: pa.Table) -> pa.Table | None:
        t = _first_of_each(t)
        if t.num_rows < 2:
            return None
        size = t.column("n").to_numpy()
        bits = np.frombuffer(b"".join(t.column("bits").to_pylist()), np.uint64).reshape(len(size), -1)
        keep = np.zeros(len(size), bool)
        for p in range(len(size)):
            close = np.flatnonzero((size >= threshold * size[p]) & (size * threshold <= size[p]))
            lost = np.bitwise_count(bits[p] & ~bits[close]).sum(1)
            gone = np.bitwise_count(~bits[p] & bits[close]).sum(1)
            most = np.minimum(size[p] - lost, size[close] - gone)
            near = most >= threshold * (size[p] + size[close] - most) - 1e-9
            keep[p] = near.sum() > 1  # itself is one
        return t.select(["key", "uid"]).filter(pa.array(keep))

    left = materialise(by_group(fit, ["key"], survivors, "key long, uid long"), "pruned")
    whole = buckets.join(sized.where(F.col("m") > PART_ROWS).select("key"), "key", "left_semi")
    return left.unionByName(whole.select("key", "uid"))


def _edges(a, b, left=None) -> pa.Table:
    left = np.zeros(len(a), bool) if left is None else left
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "left": pa.array(left, pa.bool_())})


_EDGE = "a long, b long, left boolean"


def _parts(rows: DataFrame, part_bytes: int) -> DataFrame:
    """(key, m, parts, head) from (key, uid, bytes) rows."""
    sized = rows.groupBy("key").agg(F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("m"), F.min("uid").alias("head"))
    return sized.select("key", "m", F.greatest(F.ceil(F.col("bytes") / part_bytes), F.ceil(F.col("m") / PART_ROWS)).cast("int").alias("parts"), "head")


def as_sets(blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The values of sets end to end, and how many each has; blobs are the sets' bytes."""
    return np.frombuffer(b"".join(blobs), np.uint64), np.array([len(b) // 8 for b in blobs], np.int64)


def links(buckets: DataFrame, sets: DataFrame, threshold: float, part_bytes: int = PART_BYTES, expand=as_sets) -> DataFrame:
    """(a, b) links between uids of a bucket, verified by exact Jaccard.

    ``sets`` has (uid, set): sorted distinct 64-bit values as bytes, or whatever
    ``expand`` makes such sets of. They are joined to rows that already know their
    task, so they are moved once.
    """
    sizes = sets.select("uid", F.length("set").alias("bytes"))
    sized = materialise(_parts(buckets.join(sizes, "uid"), part_bytes), "sized")
    large = sized.where("parts > 1")
    dealt = buckets.join(sized.select("key", "head", "parts"), "key").withColumn("part", F.pmod(F.xxhash64("uid"), F.col("parts")).cast("int"))
    # The head goes to every part of its bucket.
    heads = large.select("key", F.col("head").alias("uid"), "head", "parts", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    dealt = dealt.where("parts = 1 or uid <> head").select("key", "uid", "head", "parts", "part").unionByName(heads)

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, starts in many_groups(batches, 2, 5, CHUNK_BYTES * part_bytes // PART_BYTES):
            uids, parts, heads, key = (t.column(c).to_numpy() for c in ("uid", "parts", "head", "key"))
            group = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(uids))))
            order = np.lexsort((uids, group))
            new = np.ones(len(order), bool)  # a uid may come twice
            new[1:] = (uids[order][1:] != uids[order][:-1]) | (group[order][1:] != group[order][:-1])
            order = order[new]
            uids, group = uids[order], group[order]
            values, count = expand(t.column("set").take(pa.array(order)).to_pylist())
            a, b, component = Members(values, count, group).spanning_links(threshold)
            yield from _edges(uids[a], uids[b]).to_batches()
            many = parts[order] > 1
            if many.any():  # what is not in the head's group has yet to meet the other parts
                own = np.full(len(starts), -1)
                is_head = many & (uids == heads[order])
                own[group[is_head]] = component[is_head]
                out = many & (component != own[group])
                yield from _edges(key[order][out], uids[out], np.ones(out.sum(), bool)).to_batches()

    placed = dealt.select("key", "part", "uid", "head", "parts").join(sets, "uid").select("key", "part", "uid", "head", "parts", "set")
    first = materialise(placed.repartition("key", "part").sortWithinPartitions("key", "part").mapInArrow(lean(linked), _EDGE), "links")
    over = first.where("left").select(F.col("a").alias("key"), F.col("b").alias("uid"))
    out = first.where("not left").select("a", "b")
    if large.isEmpty() or over.isEmpty():
        return out
    room = _parts(over.join(sizes, "uid"), part_bytes).select("key", F.col("parts").alias("blocks"))
    room = materialise(room.join(sized.select("key", "parts"), "key"), "room")
    mine = over.join(room, "key").select("key", "uid", F.lit(True).alias("mine"), F.pmod(F.xxhash64("uid"), F.col("blocks")).cast("int").alias("block"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    theirs = buckets.join(room, "key").select("key", "uid", F.lit(False).alias("mine"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.pmod(F.xxhash64("uid"), F.col("parts")).cast("int").alias("part"))

    def meet(t: pa.Table) -> pa.Table:
        uids, mine_ = t.column("uid").to_numpy(), np.array(t.column("mine").to_pylist())
        s = Sets(*expand(t.column("set").to_pylist()))
        others = np.flatnonzero(~mine_)
        flat, cut = s.flat(others)
        a, b = [], []
        for p in np.flatnonzero(mine_):
            hit = others[s.near(p, others, flat, cut, threshold)]
            hit = hit[uids[hit] != uids[p]]
            a += [int(uids[p])] * len(hit)
            b += uids[hit].tolist()
        return _edges(a, b)

    # Few sets take part, so the rows that name them go to the sets, not the sets to the rows.
    both = materialise(mine.unionByName(theirs), "both")
    met = sets.join(bounded(both), "uid").select("key", "uid", "mine", "block", "part", "set")
    second = by_group(met, ["key", "block", "part"], meet, _EDGE).select("a", "b")
    return out.unionByName(materialise(second, "links"))


def dense(buckets: DataFrame, sets: DataFrame, threshold: float, expand=as_sets) -> DataFrame:
    """Keys of the buckets of which at least half is near the first member.

    Such a group shares nearly all its values, so no split takes it apart, while
    linking it to its first member settles it in one pass.
    """
    heads = buckets.groupBy("key").agg(F.min("uid").alias("uid"))
    heads = materialise(sets.join(bounded(heads), "uid").select("key", F.col("set").alias("head_set")), "heads")
    rows = sets.join(bounded(buckets), "uid").join(bounded(heads, F.length("head_set")), "key").select("key", "set", "head_set")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j in chunks(pc.binary_length(b.column(1)).to_pylist(), CHUNK_BYTES):
                n = j - i  # each member and its head are a group of two
                values, count = expand([x for y in zip(b.column(2)[i:j].to_pylist(), b.column(1)[i:j].to_pylist(), strict=True) for x in y])
                head = 2 * np.arange(n)
                near = Members(values, count, np.repeat(np.arange(n), 2)).near(head, head, head + 1, threshold)
                yield pa.RecordBatch.from_arrays([b.column(0)[i:j], pa.array(near)], ["key", "near"])

    shares = rows.mapInArrow(lean(run), "key long, near boolean").groupBy("key").agg(F.avg(F.col("near").cast("double")).alias("share"))
    return materialise(shares.where("share >= 0.5").select("key"), "dense")


#: Slots that say how common a large bucket's values are, and members whose values are counted for them.
SLOTS, SAMPLED = 512, 1_000


def _slot(values: np.ndarray) -> np.ndarray:
    return (mix(values) % np.uint64(SLOTS)).astype(np.int64)


def _levels(t: pa.Table, expand) -> bytes:
    """SLOTS levels of commonness: of each slot's most frequent value among these members."""
    values, count = expand(t.column("set").to_pylist())
    pairs = np.unique(np.stack((np.repeat(np.arange(len(count)), count).astype(np.uint64), values)), axis=1)
    found, often = np.unique(pairs[1], return_counts=True)
    out = np.zeros(SLOTS, np.uint8)
    np.maximum.at(out, _slot(found), np.minimum(np.log2(often * 64 / len(count) + 1) * 16, 255).astype(np.uint8))
    return out.tobytes()


def size_edges(most: int, threshold: float) -> np.ndarray:
    """Least sizes of classes; sets that reach the threshold are in one class or in two that adjoin."""
    out = [1]
    while out[-1] <= most or len(out) < 3:
        out.append(int(out[-1] / threshold + 1e-6) + 1)
    return np.array([*out, int(out[-1] / threshold + 1e-6) + 1])


def prefix_keys(values: np.ndarray, count: np.ndarray, key: np.ndarray, levels: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(member, key) such that any two members of a bucket that reach the threshold share a key.

    All members of bucket ``key`` put their values in one order, rare ones first. Sets
    of a and b values that reach t share t/(1+t) * (a+b) of them at least, the first of
    which both have among as many first values as they may lack, plus one. b is only
    known by its class, so there is a key for each class that b may be in.
    """
    of = np.repeat(np.arange(len(count)), count)
    h = mix(values ^ mix(key)[of])  # one to one within a bucket
    order = np.lexsort((h, levels[of, _slot(values)], of))
    h, of = h[order], of[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (of[1:] != of[:-1])
    h, of = h[new], of[new]
    n = np.bincount(of, minlength=len(count))
    at = np.concatenate(([0], np.cumsum(n)))[:-1]
    edges = size_edges(int(n.max(initial=1)), threshold)
    mine = np.searchsorted(edges, n, "right") - 1
    members, keys = [], []
    for step in (-1, 0, 1):
        other = np.maximum(mine + step, 0)
        least = np.maximum(edges[other], np.ceil(threshold * n - 1e-6))
        most = np.minimum(edges[other + 1] - 1, np.floor(n / threshold + 1e-6))
        shared = np.ceil(threshold / (1 + threshold) * (n + least) - 1e-6)
        take = np.where((n > 0) & (mine + step >= 0) & (least <= most), np.clip(n - shared + 1, 0, n), 0).astype(np.int64)
        pair = mix((2 * np.minimum(mine, other) + abs(step) + 1).astype(np.uint64))
        members.append(np.repeat(np.arange(len(count)), take))
        keys.append(mix(h[ranges(at, take)[0]] + np.repeat(pair, take)))
    return np.concatenate(members), np.concatenate(keys)


def split_exactly(buckets: DataFrame, sets: DataFrame, small: int, threshold: float, depth: int, expand=as_sets) -> DataFrame:
    """Split buckets with more than ``small`` members so that no link is lost.

    Members that reach the threshold share a key of ``prefix_keys``, so the links found
    don't depend on whether a bucket is split. How common values are is estimated on
    some SAMPLED members of a bucket; that only decides how far it is taken apart. A
    bucket that is mostly near its first member stays whole (see ``dense``), and what
    is still large after ``depth`` splits is compared in parts.
    """
    done, now = None, buckets
    for _ in range(depth):
        sized = materialise(now.groupBy("key").agg(F.count(F.lit(1)).alias("m")).where(F.col("m") > small), "counts")
        if sized.isEmpty():
            break
        big = materialise(now.join(bounded(sized), "key"), "big")
        apart = materialise(sized.join(dense(big.select("key", "uid"), sets, threshold, expand), "key", "left_anti").select("key"), "apart")
        fine = now.join(bounded(apart), "key", "left_anti")
        done = fine if done is None else done.unionByName(fine)
        if apart.isEmpty():
            return done
        wide = materialise(big.join(bounded(apart), "key", "left_semi"), "wide")
        some = wide.where(F.pmod(F.xxhash64("uid"), F.col("m")) < SAMPLED).select("key", "uid")

        def weigh(t: pa.Table) -> pa.Table:
            return pa.table({"key": t.column("key").slice(0, 1), "levels": pa.array([_levels(t, expand)], pa.binary())})

        levels = materialise(by_group(sets.join(bounded(some), "uid").select("key", "set"), ["key"], weigh, "key long, levels binary"), "levels")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for i, j in chunks(pc.binary_length(b.column(2)).to_pylist(), CHUNK_BYTES // 2):
                    values, count = expand(b.column(2)[i:j].to_pylist())
                    own = np.frombuffer(b"".join(b.column(3)[i:j].to_pylist()), np.uint8).reshape(-1, SLOTS)
                    members, keys = prefix_keys(values, count, b.column(0)[i:j].to_numpy().view(np.uint64), own, threshold)
                    yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), b.column(1)[i:j].take(pa.array(members))], ["key", "uid"])

        parents = sets.join(bounded(wide.select("key", "uid")), "uid").join(bounded(levels, F.length("levels")), "key", "left")
        parents = parents.select("key", "uid", "set", F.coalesce("levels", F.lit(bytes(SLOTS))).alias("levels"))
        parts = materialise(parents.mapInArrow(lean(run), "key long, uid long"), "split")
        now = live_buckets(parts)
        discard(big, wide, levels, parts)
    return now if done is None else done.unionByName(now)


def count_links(classes: DataFrame, sets: DataFrame, threshold: float, part_bytes: int = PART_BYTES // 2) -> DataFrame:
    """(uid, n): rows whose set reaches the threshold against uid's, its own copies excluded.

    ``classes`` has (uid, component, copies). All members of a class are compared
    with each other, in tiles of two bounded parts; only sums leave a tile.
    """
    sizes = sets.select("uid", F.length("set").alias("bytes"))
    sized = _parts(classes.join(sizes, "uid").withColumnRenamed("component", "key"), part_bytes)
    placed = classes.withColumnRenamed("component", "key").join(sized.select("key", "parts"), "key").withColumn("part", F.pmod(F.xxhash64("uid"), F.col("parts")).cast("int"))
    tiled = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    tiled = tiled.select("key", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "uid", "copies", "part").join(sets, "uid")

    def tile(t: pa.Table) -> pa.Table:
        t = _first_of_each(t)
        uids, part = t.column("uid").to_numpy(), t.column("part").to_numpy()
        copies, i, j = t.column("copies").to_numpy(), t.column("i")[0].as_py(), t.column("j")[0].as_py()
        s = Sets(*as_sets(t.column("set").to_pylist()))
        total = np.zeros(len(uids), np.int64)
        left, right = np.flatnonzero(part == i), np.flatnonzero(part == j)
        flat, cut = s.flat(right)
        for p in left:
            hit = right[s.near(p, right, flat, cut, threshold)]
            hit = hit[hit != p]
            total[p] += copies[hit].sum()
            if i != j:
                total[hit] += copies[p]
        return pa.table({"uid": pa.array(uids), "n": pa.array(total)})

    return by_group(tiled, ["key", "i", "j"], tile, "uid long, n long").groupBy("uid").agg(F.sum("n").alias("n"))


def set_batches(rows: Iterator[tuple[int, bytes]], limit: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """(uid, set) record batches of about ``limit`` bytes each."""
    uids, blobs, held = [], [], 0
    make = lambda: pa.RecordBatch.from_arrays([pa.array(uids, pa.int64()), pa.array(blobs, pa.binary())], ["uid", "set"])
    for uid, values in rows:
        uids.append(uid)
        blobs.append(values)
        held += len(values) + 16
        if held >= limit:
            yield make()
            uids, blobs, held = [], [], 0
    if uids:
        yield make()
