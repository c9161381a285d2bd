"""N-gram Jaccard self join by prefix filtering under several global orders.

Two sets link when ``100 * intersection >= percent * union``. Under any one order of all tokens, the
first ``size - ceil(percent * size / 100) + 1`` tokens of two linked sets (their prefixes) share a
token. Here every order ranks tokens by the number of sets that hold them, rarest first, and breaks
ties by a different hash; a pair is a candidate only if the prefixes share a token under each of the
orders. The filters are intersected before the sets themselves are compared.

Steps:

1. Equal sets become one vertex (its key is a 64-bit hash of the set). Tokens found in a 256th of any
   task's sets are listed as frequent: at most 256 times the mean set size of them exist.
2. Tokens are counted in ranges of their hash. A token held by one set only can link nothing, so only
   the others go back to their sets. Frequent tokens skip the count, keep the last place in the
   order, and pass in salted groups. A set in which too few tokens are shared is done.
3. Sets that share a token of their prefix in the first order meet. First each is compared with the
   most typical set there (a star, linear in the group), which joins whole groups of near copies at once.
   Then sets are compared with the members of the larger components that they meet, and sets still
   alone with the others of their family. These comparisons run in blocks of bounded size over an
   index of the block's tokens, and hand out only links that join something. Pairs inside one
   component are not compared here: they can't change it.
4. Where links are counted, all pairs of sets of one component are compared, in blocks of bounded
   size; there are no links between components. Tokens held by an eighth of a block's sets are
   counted by a matrix product, others by an index. A block gives a sum per set, not pairs. A document's
   links are the documents of the sets that link with its own, and the others of its own set.

Defined cases: a null text or one without words has no shingles, links with nothing and is its own
component, with no links; fewer words than a shingle make one shingle of them all; a null id never is a component's
name (a component of null ids only has none); rows that repeat are separate documents with the same
set; an empty table gives an empty result; other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator


import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import (
    for_python, from_planes, planes, repeatable_turn, splitmix, staged,
)
from tidemark.llm.components import components
from tidemark.llm.shingles import set_key, sets_in

PERCENT = 75
ORDERS = 3
_FREQUENT_SHARE = 256
_FLUSH = 1 << 20  # tokens kept by a task before it writes them out
_RANGE = 1 << 20  # tokens in one range of hashes, about
_BLOCK = 1 << 21  # tokens compared in one task, about
_PAIR_BLOCK = 1 << 19  # tokens on either side where all pairs are compared, about
_SET_COST = 64  # what a set adds to them, so that blocks of short sets stay small
_CELLS = 1 << 22  # pairs and index hits held at once
_DENSE_SHARE = 8
_FREQUENT = np.uint32(0xFFFFFFFF)


def least_overlap(size: np.ndarray | int, percent: int = PERCENT) -> np.ndarray | int:
    """Tokens that a linked partner must share with a set of this size."""
    return -(-percent * size // 100)


def document_sets(docs: DataFrame) -> DataFrame:
    """doc_id, key, n_shingles per document; rows with a null key carry a task's frequent tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, sets, seen = [], 0, set()
        common = np.zeros(0, dtype=np.uint64)
        counts = np.zeros(0, dtype=np.int64)

        def folded() -> tuple[np.ndarray, np.ndarray]:
            tokens, inverse = np.unique(np.concatenate([common, *held]), return_inverse=True)
            n = np.bincount(inverse[:common.size], counts, tokens.size).astype(np.int64)
            n += np.bincount(inverse[common.size:], minlength=tokens.size)
            # a token dropped here missed at most this share of the sets so far (lossy counting)
            keep = n >= max(2, sets // (4 * _FREQUENT_SHARE))
            return tokens[keep], n[keep]

        for piece, shingles in sets_in(batches, "text"):
            keys = [set_key(s) for s in shingles]
            for key, s in zip(keys, shingles, strict=True):
                if s.size and key not in seen:
                    seen.add(key)
                    held.append(s)
                    sets += 1
            if sum(s.size for s in held) > _FLUSH:
                common, counts = folded()
                held = []
            yield _stat_rows(piece.column(0), keys, [s.size for s in shingles])
        common, counts = folded()
        often = counts >= max(8, sets // (2 * _FREQUENT_SHARE))
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.array([0], pa.int64()),
             pa.array([common[often].view(np.int64)], _LONGS), pa.array([counts[often]], _LONGS)],
            names=_STATS)

    return for_python(docs).select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, key long, n_shingles long, frequent array<long>, times array<long>")


_LONGS = pa.list_(pa.int64())
_STATS = ["doc_id", "key", "n_shingles", "frequent", "times"]


def _stat_rows(ids: pa.Array, keys: list[int], sizes: list[int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [ids, pa.array(keys, pa.int64()), pa.array(sizes, pa.int64()),
         pa.nulls(len(keys), _LONGS), pa.nulls(len(keys), _LONGS)],
        names=_STATS)


def frequent_tokens(stats: DataFrame, sets: int) -> np.ndarray:
    """Tokens of at least a 256th of all sets are among them; at most 512 times the mean set size
    reach the bar, whatever the number of sets."""
    rows = stats.filter("frequent is not null").select(
        F.explode(F.arrays_zip("frequent", "times")).alias("x")).groupBy("x.frequent").agg(
        F.sum("x.times").alias("times")).filter(
        F.col("times") >= max(8, sets // (2 * _FREQUENT_SHARE))).select("frequent").collect()
    return np.sort(np.array([r[0] for r in rows], dtype=np.int64).view(np.uint64))


def _token_ranges(docs: DataFrame, ranges: int, frequent: np.ndarray) -> DataFrame:
    """Packed (range, tokens, owner index, owners' keys and sizes). Frequent tokens go to groups of
    their own, as many as keep them small."""
    salts = max(64, ranges // 8)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        held: list[np.ndarray] = []
        keys: list[int] = []

        def flush() -> pa.RecordBatch:
            tokens = np.concatenate(held)
            salt = repeatable_turn(keys, salts)
            owner = np.repeat(np.arange(len(held), dtype=np.uint32), [s.size for s in held])
            key = np.array(keys, dtype=np.int64)
            size = np.array([s.size for s in held], dtype=np.uint32)
            part = (tokens >> np.uint64(32)).astype(np.int64) * ranges >> 32
            if frequent.size:
                at = np.minimum(np.searchsorted(frequent, tokens), frequent.size - 1)
                part[frequent[at] == tokens] = ranges + salt
            order = np.lexsort((tokens, part))
            tokens, owner, part = tokens[order], owner[order], part[order]
            edges = np.flatnonzero(np.diff(part, prepend=-1, append=-1))
            rows = []
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                used, index = np.unique(owner[a:b], return_inverse=True)
                rows.append((int(part[a]), planes(tokens[a:b]),
                             planes(index.astype(np.uint32)),
                             key[used].tobytes(), size[used].tobytes()))
            return pa.RecordBatch.from_pylist(
                [dict(zip(_PACKED, r, strict=True)) for r in rows], schema=_PACKED_SCHEMA)

        total = 0
        for _, shingles in sets_in(batches, "text"):
            for s in shingles:
                key = set_key(s)
                if not s.size or key in seen:
                    continue
                seen.add(key)
                held.append(s)
                keys.append(key)
                total += s.size
                if total > _FLUSH:
                    yield flush()
                    held, keys, total = [], [], 0
        if held:
            yield flush()

    return for_python(docs).select("text").mapInArrow(
        run, "part long, tokens binary, owner binary, keys binary, sizes binary")


_PACKED = ("part", "tokens", "owner", "keys", "sizes")
_PACKED_SCHEMA = pa.schema([("part", pa.int64()), *((n, pa.binary()) for n in _PACKED[1:])])


def _shared_tokens(packed: DataFrame, ranges: int, groups: int) -> DataFrame:
    """Tokens held by two sets or more, with the number of sets, packed by group of sets."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        tokens, keys, sizes = [], [], []
        for r in pdf.itertuples(index=False):
            owner = from_planes(r.owner, np.uint32)
            tokens.append(from_planes(r.tokens, np.uint64))
            keys.append(np.frombuffer(r.keys, dtype=np.int64)[owner])
            sizes.append(np.frombuffer(r.sizes, dtype=np.uint32)[owner])
        token, key, size = map(np.concatenate, (tokens, keys, sizes))
        order = np.lexsort((key, token))
        token, key, size = token[order], key[order], size[order]
        fresh = np.ones(token.size, dtype=bool)  # a set met in several tasks counts once
        fresh[1:] = (token[1:] != token[:-1]) | (key[1:] != key[:-1])
        token, key, size = token[fresh], key[fresh], size[fresh]
        if pdf["part"].iloc[0] >= ranges:
            count = np.full(token.size, _FREQUENT, dtype=np.uint32)
        else:
            edges = np.flatnonzero(np.r_[True, token[1:] != token[:-1], True])
            count = np.repeat(np.diff(edges), np.diff(edges)).astype(np.uint32)
            shared = count > 1
            token, key, size, count = token[shared], key[shared], size[shared], count[shared]
        group = (splitmix(key.view(np.uint64)) % np.uint64(groups)).astype(np.int64)
        order = np.lexsort((token, group))
        rows = []
        edges = np.flatnonzero(np.diff(group[order], prepend=-1, append=-1))
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            o = order[a:b]
            used, index = np.unique(key[o], return_inverse=True)
            size_of = np.zeros(used.size, dtype=np.uint32)
            size_of[index] = size[o]
            rows.append((int(group[o[0]]), planes(token[o]), planes(index.astype(np.uint32)),
                         planes(count[o]), used.tobytes(), size_of.tobytes()))
        return pd.DataFrame(rows, columns=["part", "tokens", "owner", "counts", "keys", "sizes"])

    return packed.groupBy("part").applyInPandas(
        run, "part long, tokens binary, owner binary, counts binary, keys binary, sizes binary")


def _prefix_masks(token: np.ndarray, count: np.ndarray, length: int, orders: int) -> np.ndarray:
    """Bit k of a token's mask: it lies in the prefix of the k-th order."""
    mask = np.zeros(token.size, dtype=np.uint8)
    for k in range(orders):
        tie = splitmix(token ^ np.uint64(k + 1))
        mask[np.lexsort((tie, count))[:length]] |= np.uint8(1 << k)
    return mask


def _filtered_sets(shared: DataFrame, percent: int, orders: int) -> DataFrame:
    """Sets with enough shared tokens to link at all: key, n, tokens, masks, and how typical a set
    is: the mean log count of its tokens, highest for the middle of a group of near copies."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        parts = []
        for r in pdf.itertuples(index=False):
            owner = from_planes(r.owner, np.uint32)
            parts.append((np.frombuffer(r.keys, dtype=np.int64)[owner],
                          from_planes(r.tokens, np.uint64), from_planes(r.counts, np.uint32),
                          np.frombuffer(r.sizes, dtype=np.uint32)[owner]))
        key, token, count, size = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.lexsort((token, key))
        key, token, count, size = key[order], token[order], count[order], size[order]
        edges = np.flatnonzero(np.r_[True, key[1:] != key[:-1], True])
        rows = []
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            # frequent tokens of a set met in several tasks come in several salted groups
            fresh = np.r_[True, token[a + 1:b] != token[a:b - 1]]
            t, c, n = token[a:b][fresh], count[a:b][fresh], int(size[a])
            need = least_overlap(n, percent)
            if t.size >= need:
                masks = _prefix_masks(t, c, t.size - need + 1, orders)
                rows.append((int(key[a]), n, t.tobytes(), masks.tobytes(),
                             float(np.log2(c).sum() / n)))
        return pd.DataFrame(rows, columns=["key", "n", "tokens", "masks", "typical"])

    return shared.groupBy("part").applyInPandas(
        run, "key long, n long, tokens binary, masks binary, typical double")


def _postings(token: np.ndarray, probe: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every token of the probe, the places of equal tokens in a sorted array."""
    low = np.searchsorted(token, probe, side="left")
    many = np.searchsorted(token, probe, side="right") - low
    ahead = np.repeat(low - np.cumsum(many) + many, many)
    return ahead + np.arange(ahead.size), np.repeat(np.arange(probe.size), many)


def _links_of_unit(pdf: pd.DataFrame, percent: int, orders: int) -> list[tuple[int, int]]:
    """Links between probes and targets (rows that are both meet each other), as many as it takes to
    join what they join."""
    keys, sizes = pdf["key"].to_numpy(), pdf["n"].to_numpy()
    tokens = [np.frombuffer(x, dtype=np.uint64) for x in pdf["tokens"]]
    masks = [np.frombuffer(x, dtype=np.uint8) for x in pdf["masks"]]
    is_target, is_probe = pdf["target"].to_numpy(), pdf["probe"].to_numpy()
    targets = np.flatnonzero(is_target)
    if not targets.size:
        return []
    token = np.concatenate([tokens[i] for i in targets])
    mask = np.concatenate([masks[i] for i in targets])
    owner = np.repeat(targets, [tokens[i].size for i in targets])
    order = np.argsort(token, kind="stable")
    token, mask, owner = token[order], mask[order], owner[order]
    root = list(range(len(keys)))

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    links = []
    for i in np.flatnonzero(is_probe):
        at, mine = _postings(token, tokens[i])
        shared = mask[at] & masks[i][mine]
        other = owner[at]
        able = np.ones(len(keys), dtype=bool)
        for k in range(orders):
            able &= np.bincount(other[shared & (1 << k) > 0], minlength=len(keys)) > 0
        able[i] = False
        if not able.any():
            continue
        both = np.bincount(other, minlength=len(keys))
        able &= 100 * both >= percent * (sizes[i] + sizes - both)
        for j in np.flatnonzero(able):
            a, b = top(int(i)), top(int(j))
            if a != b:
                root[a] = b
                links.append((int(keys[i]), int(keys[j])))
    return links


def _linked(units: DataFrame, sets: DataFrame, percent: int, orders: int) -> DataFrame:
    """``units(u, v, w, key, target, probe)``: in each unit (u, v, w) the probes are compared with
    the targets; (a, b) pairs of keys that link."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(_links_of_unit(pdf, percent, orders), columns=["a", "b"])

    return units.join(sets.drop("typical"), "key").groupBy("u", "v", "w").applyInPandas(
        run, "a long, b long")


def _block_of(key: str, blocks: Column, seed: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(seed)), blocks).cast("int")


def _all_blocks(blocks: Column) -> Column:
    return F.explode(F.sequence(F.lit(0), blocks - 1))


def _star_units(meetings: DataFrame) -> DataFrame:
    """Every set with the most typical set of each of its groups."""
    middle = meetings.groupBy("token").agg(F.count("*").alias("c"), F.max(
        F.struct("typical", "key"))["key"].alias("u")).filter("c > 1").select("token", "u")
    pairs = meetings.join(middle, "token").filter("key <> u").select("u", "key", "m").distinct()
    pairs = staged(pairs, "stars")
    blocks = pairs.groupBy("u").agg(_blocks_of_sum().alias("blocks"))
    probes = pairs.join(blocks, "u").select(
        "u", F.lit(0).alias("v"), _block_of("key", F.col("blocks"), 1).alias("w"), "key",
        F.lit(False).alias("target"), F.lit(True).alias("probe"))
    centres = blocks.select(
        "u", F.lit(0).alias("v"), _all_blocks(F.col("blocks")).alias("w"),
        F.col("u").alias("key"), F.lit(True).alias("target"), F.lit(False).alias("probe"))
    return probes.union(centres)


def _blocks_of_sum() -> Column:
    return F.ceil(F.sum("m") / _BLOCK).cast("int")


def _component_units(placed: DataFrame) -> DataFrame:
    """Sets with the components of two sets or more that they meet but don't belong to; of two
    components the smaller one's sets are the probes. ``placed(token, key, m, comp, size)``."""
    large = placed.filter("size > 1").select(
        "token", F.col("comp").alias("u"), F.col("size").alias("other")).distinct()
    probes = staged(placed.join(large, "token").filter(
        F.struct("size", "comp") < F.struct("other", "u")).select("u", "key", "m").distinct(),
        "probes")
    probe_blocks = probes.groupBy("u").agg(_blocks_of_sum().alias("pb"))
    members = placed.filter("size > 1").select(F.col("comp").alias("u"), "key", "m").distinct().join(
        probe_blocks.select("u"), "u", "left_semi")
    blocks = members.groupBy("u").agg(_blocks_of_sum().alias("tb")).join(probe_blocks, "u")
    targets = members.join(blocks, "u").select(
        "u", _block_of("key", F.col("tb"), 2).alias("v"), _all_blocks(F.col("pb")).alias("w"), "key",
        F.lit(True).alias("target"), F.lit(False).alias("probe"))
    asking = probes.join(blocks, "u").select(
        "u", _all_blocks(F.col("tb")).alias("v"), _block_of("key", F.col("pb"), 3).alias("w"), "key",
        F.lit(False).alias("target"), F.lit(True).alias("probe"))
    return targets.union(asking)


def _single_units(placed: DataFrame) -> DataFrame:
    """Sets that are still alone, with all others of their family: those that meet, directly or
    through others that are alone. A family is dealt in blocks of a row and a column."""
    alone = placed.filter("size = 1").select("token", "key", "m")
    least = alone.groupBy("token").agg(F.min("key").alias("b"), F.count("*").alias("c")).filter("c > 1")
    met = alone.join(least, "token").filter("key <> b").select(F.col("key").alias("a"), "b")
    families = staged(components(met), "families").select(
        F.col("node").alias("key"), F.col("component").alias("u"))
    members = alone.select("key", "m").distinct().join(families, "key")
    blocks = members.groupBy("u").agg(_blocks_of_sum().alias("b"))
    mine = members.join(blocks, "u").withColumn("own", _block_of("key", F.col("b"), 4))
    return mine.select(
        "u", "key", "own", _all_blocks(F.col("b")).alias("with")).select(
        "u", F.least("own", "with").alias("v"), F.greatest("own", "with").alias("w"), "key",
        (F.col("own") <= F.col("with")).alias("target"),
        (F.col("own") >= F.col("with")).alias("probe"))


def _meetings(sets: DataFrame) -> DataFrame:
    """(token, key, typical, m): the prefix of each set under the first order; m is the number of
    tokens of the set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in filter(lambda b: b.num_rows, batches):
            tokens, keys, typical, many = [], [], [], []
            for i in range(batch.num_rows):
                t = np.frombuffer(batch.column("tokens")[i].as_buffer(), dtype=np.int64)
                m = np.frombuffer(batch.column("masks")[i].as_buffer(), dtype=np.uint8)
                tokens.append(t[m & 1 > 0])
                keys.append(np.full(tokens[-1].size, batch.column("key")[i].as_py()))
                typical.append(np.full(tokens[-1].size, batch.column("typical")[i].as_py()))
                many.append(np.full(tokens[-1].size, t.size))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(x)) for x in (tokens, keys, typical, many)],
                names=["token", "key", "typical", "m"])

    return for_python(sets).select("key", "tokens", "masks", "typical").mapInArrow(
        run, "token long, key long, typical double, m long")


def _placed(meetings: DataFrame, groups: DataFrame) -> DataFrame:
    named = meetings.select("token", "key", "m").join(
        groups.select(F.col("node").alias("key"), "component"), "key", "left").withColumn(
        "comp", F.coalesce("component", "key"))
    sizes = groups.groupBy("component").agg(F.count("*").alias("size"))
    placed = named.join(sizes, "component", "left").select(
        "token", "key", "m", "comp", F.coalesce("size", F.lit(1)).alias("size"))
    # a group of one component has nothing left to compare
    open_groups = placed.groupBy("token").agg(
        F.min("comp").alias("x"), F.max("comp").alias("y")).filter("x <> y").select("token")
    return staged(placed.join(open_groups, "token", "left_semi"), "placed")


def _runs_of(values: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges whose values add up to ``most`` at most (or that hold one value)."""
    sums = np.cumsum(values)
    start = 0
    while start < values.size:
        base = sums[start - 1] if start else 0
        stop = max(int(np.searchsorted(sums, base + most, side="right")), start + 1)
        yield start, stop
        start = stop


def _weights_of_links(probes: pd.DataFrame, targets: pd.DataFrame, percent: int,
                      ) -> tuple[np.ndarray, np.ndarray]:
    """Per probe the sum of the weights of the other sets it links with among the targets, and per
    target that among the probes."""
    held = [np.frombuffer(x, dtype=np.uint64) for x in targets["tokens"]]
    asked = [np.frombuffer(x, dtype=np.uint64) for x in probes["tokens"]]
    n = len(held)
    token = np.concatenate(held)
    owner = np.repeat(np.arange(n), [t.size for t in held])
    names, column, times = np.unique(token, return_inverse=True, return_counts=True)
    dense = times * _DENSE_SHARE >= n
    place = np.cumsum(dense) - 1
    wide = int(dense.sum())
    kind = np.float32 if wide < 1 << 24 else np.float64
    right = np.zeros((n, wide), dtype=kind)
    often = dense[column]
    right[owner[often], place[column[often]]] = 1
    rare, rare_owner = column[~often], owner[~often]
    order = np.argsort(rare, kind="stable")
    rare, rare_owner = rare[order], rare_owner[order]
    key_p, key_t = probes["key"].to_numpy(), targets["key"].to_numpy()
    size_p, size_t = probes["n"].to_numpy(), targets["n"].to_numpy()
    many_p, many_t = probes["weight"].to_numpy(), targets["weight"].to_numpy()
    out_p, out_t = np.zeros(len(asked), dtype=np.int64), np.zeros(n, dtype=np.int64)

    known = []  # per probe its tokens that a target holds, as columns
    for t in asked:
        at = np.minimum(np.searchsorted(names, t), names.size - 1)
        known.append(at[names[at] == t])
    cost = np.array([max(n, wide, int(times[c[~dense[c]]].sum())) for c in known])
    for a, b in _runs_of(cost, _CELLS):
        mine = np.concatenate(known[a:b])
        row = np.repeat(np.arange(b - a), [c.size for c in known[a:b]])
        left = np.zeros((b - a, wide), dtype=kind)
        often = dense[mine]
        left[row[often], place[mine[often]]] = 1
        both = (left @ right.T).astype(np.int64)
        hit, of = _postings(rare, mine[~often])
        both += np.bincount(
            row[~often][of] * n + rare_owner[hit], minlength=(b - a) * n).reshape(b - a, n)
        linked = (100 * both >= percent * (size_p[a:b, None] + size_t - both)) & (
            key_p[a:b, None] != key_t)
        out_p[a:b] = linked @ many_t
        out_t += many_p[a:b] @ linked
    return out_p, out_t


def _link_units(members: DataFrame) -> DataFrame:
    """``members(u, key, weight, m)`` of components ``u``: large components are dealt in blocks of a
    row ``v`` and a column ``w``, small ones share units ``bin``."""
    cost = F.col("m") + _SET_COST
    sizes = members.groupBy("u").agg(F.ceil(F.sum(cost) / _PAIR_BLOCK).cast("int").alias("b"))
    bins = max(1, (members.agg(F.sum(cost)).first()[0] or 0) // _PAIR_BLOCK)
    placed = members.join(sizes, "u").withColumn("own", _block_of("key", F.col("b"), 5))
    return placed.select(
        "u", "key", "weight", "own", F.when(F.col("b") > 1, F.col("u")).otherwise(
            F.pmod(F.xxhash64("u", F.lit(6)), F.lit(bins))).alias("bin"),
        _all_blocks(F.col("b")).alias("with")).select(
        "bin", F.least("own", "with").alias("v"), F.greatest("own", "with").alias("w"), "u", "key",
        "weight", (F.col("own") <= F.col("with")).alias("target"),
        (F.col("own") >= F.col("with")).alias("probe"))


def _linked_documents(able: DataFrame, groups: DataFrame, weights: DataFrame,
                      percent: int) -> DataFrame:
    """(key, linked): per set in a component the documents of other sets that link with it;
    ``weights(key, weight)`` has the documents of a set."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        keys, sums = [], []
        for _, part in pdf.groupby("u"):
            target, probe = part[part["target"]], part[part["probe"]]
            if not len(target) or not len(probe):
                continue
            asked, held = _weights_of_links(probe, target, percent)
            keys.append(probe["key"].to_numpy())
            sums.append(asked)
            if (part["v"] != part["w"]).any():  # else both sides are the same sets
                keys.append(target["key"].to_numpy())
                sums.append(held)
        if not keys:
            return pd.DataFrame({"key": [], "linked": []}, dtype="int64")
        return pd.DataFrame({"key": np.concatenate(keys), "linked": np.concatenate(sums)})

    sets = able.select("key", "n", "tokens").join(groups.select(
        F.col("node").alias("key"), F.col("component").alias("u")), "key")
    inside = staged(sets.join(weights, "key"), "linked-sets")
    units = _link_units(inside.select(
        "u", "key", "weight", (F.octet_length("tokens") / 8).cast("long").alias("m")))
    parts = units.join(inside.select("key", "n", "tokens"), "key").groupBy("bin", "v", "w").applyInPandas(
        run, "key long, linked long")
    return parts.groupBy("key").agg(F.sum("linked").alias("linked"))


def _comparable_sets(docs: DataFrame, sets: DataFrame, percent: int, orders: int) -> DataFrame:
    total = sets.filter("key is not null").agg(
        F.sum("n_shingles"), F.count_distinct(F.when(F.col("key") != 0, F.col("key")))).first()
    ranges = max(1, (total[0] or 0) // _RANGE)
    packed = _token_ranges(docs, ranges, frequent_tokens(sets, total[1]))
    return staged(_filtered_sets(
        _shared_tokens(packed, ranges, ranges), percent, orders), "filtered-sets")


def linked_components(able: DataFrame, percent: int = PERCENT, orders: int = ORDERS) -> DataFrame:
    """(node, component) over the keys of linked sets; ``able`` from :func:`_comparable_sets`."""
    meetings = staged(_meetings(able), "meetings")
    links = staged(_linked(_star_units(meetings), able, percent, orders), "star-links")
    placed = _placed(meetings, staged(components(links), "groups"))
    with_groups = staged(_linked(_component_units(placed), able, percent, orders), "group-links")
    alone = staged(_linked(_single_units(placed), able, percent, orders), "single-links")
    return components(links.union(with_groups).union(alone))


def _named_sets(docs: DataFrame, percent: int, orders: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(doc_id, key, n_shingles, g): documents with their set and component, null without shingles;
    also the comparable sets and the components."""
    sets = staged(document_sets(docs), "document-sets")
    able = _comparable_sets(docs, sets, percent, orders)
    groups = linked_components(able, percent, orders)
    named = sets.filter("key is not null").join(
        groups.select(F.col("node").alias("key"), "component"), "key", "left").select(
        "doc_id", "key", "n_shingles",
        F.when(F.col("key") != 0, F.coalesce("component", "key")).alias("g"))
    return staged(named, "named-sets"), able, groups


def join_documents(docs: DataFrame, percent: int = PERCENT, orders: int = ORDERS) -> DataFrame:
    """doc_id, n_shingles, component_id (the least doc_id reachable by links) and n_links (the other
    documents that link with it), per document."""
    named, able, groups = _named_sets(docs, percent, orders)
    least = named.filter("g is not null").groupBy("g").agg(F.min("doc_id").alias("least"))
    weights = staged(named.filter("g is not null").groupBy("key").agg(
        F.count("*").alias("weight")), "set-weights")
    linked = _linked_documents(able, groups, weights, percent)
    counts = weights.join(linked, "key", "left").select(
        "key", (F.col("weight") - 1 + F.coalesce("linked", F.lit(0))).alias("n"))
    return named.join(least, "g", "left").join(counts, "key", "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("g").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("component_id"),
        F.coalesce("n", F.lit(0)).cast("long").alias("n_links"))


def one_of_each(docs: DataFrame, percent: int = PERCENT, orders: int = ORDERS) -> DataFrame:
    """``docs`` with one document of each component, the one of least id (a null id is the last
    choice); documents without shingles all stay."""
    named, _, _ = _named_sets(docs, percent, orders)
    first = named.filter("g is not null").groupBy("g").agg(F.min(F.struct(
        F.col("doc_id").isNull().alias("none"), "doc_id", "key")).alias("x")).select(
        F.col("x.doc_id").alias("_id"), F.col("x.key").alias("_key"))
    keyed = _with_keys(docs)
    chosen = keyed.join(first, F.col("doc_id").eqNullSafe(F.col("_id")) & (
        F.col("_set") == F.col("_key")), "left_semi").dropDuplicates(["doc_id", "_set"])
    return chosen.union(keyed.filter("_set = 0")).drop("_set")


def _with_keys(docs: DataFrame) -> DataFrame:
    names = docs.columns
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema),
                        "_set long"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, shingles in sets_in(batches, "text"):
            yield pa.RecordBatch.from_arrays(
                [*(piece.column(i) for i in range(len(names))),
                 pa.array([set_key(s) for s in shingles], pa.int64())], names=[*names, "_set"])

    return for_python(docs).mapInArrow(run, schema)
