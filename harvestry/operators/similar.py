"""Fuzzy lookups and sweeps for duplicates by trigram similarity.

Pairs come from shared trigrams, not from a nested loop: a similarity above a threshold t needs k shared trigrams among the
rarest |x| - ceil(t |x|) + k of each side (prefix filtering), so names are shuffled under each of those that may be the first
one shared; a task lets them meet on it if it is rare, or on it and a second one, passes them by bitmaps, and what is left is
verified. With a block column only names of one block meet. A trigram that very many names have is dealt over tasks.

A sweep may also be kept up to date: the order of trigrams is frozen, the names' rarest trigrams are stored under it, and
new names alone look theirs up. Trigrams that the frozen order doesn't know count as the rarest.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harvestry.functions.trigram import overlap, trigrams
from harvestry.sources.staging import dealt, numbered, staged
from harvestry.sources.versions import Versions


#: Names with a trigram from which it is dealt over SALTS tasks.
HOT, SALTS = 20_000, 16


def gram_order(names: DataFrame) -> DataFrame:
    """gram, n: in how many names each trigram is. Rare ones come first in the order of prefixes, equal ones by text."""
    return names.select(F.explode(trigrams(F.col("name"))).alias("gram")).groupBy("gram").agg(F.count("*").alias("n"))


def prefixes(names: DataFrame, ranks: DataFrame, threshold: float, blocks: list[str]) -> DataFrame:
    """id, grams, blocks, gram, n: the rarest trigrams of each of names(id, grams) that a similar one can't all lack, and in
    how many names they are."""
    grams = names.select("id", "grams", *blocks, F.explode("grams").alias("gram")).join(ranks, "gram", "left")
    ordered = grams.groupBy("id", *blocks).agg(F.first("grams").alias("grams"), F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram"))).alias("by"))
    keep = F.size("by") - F.ceil(threshold * F.size("by")).cast("int") + 1
    return ordered.select("id", "grams", *blocks, F.explode(F.slice("by", F.lit(1), F.greatest(keep, F.lit(1)))).alias("g")).select("id", "grams", *blocks, "g.gram", "g.n")


def _met(x: DataFrame, y: DataFrame, blocks: list[str], hot: int) -> DataFrame:
    """Pairs of x(id, grams) and y with a common gram (and block): l_id, l_grams, r_id, r_grams. y's rows of a gram that
    many names have are dealt by a salt, and x's are copied for each."""
    x, y = x.withColumnsRenamed({"id": "l_id", "grams": "l_grams"}), y.withColumnsRenamed({"id": "r_id", "grams": "r_grams"})
    often = F.col("n") > hot
    y = y.withColumn("salt", F.when(often, F.pmod(F.xxhash64("r_id"), F.lit(SALTS)).cast("int")).otherwise(0)).drop("n")
    x = x.withColumn("salt", F.explode(F.when(often, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0))))).drop("n")
    return x.join(y, ["gram", "salt", *blocks])


def _verified(met: DataFrame, threshold: float) -> DataFrame:
    found = met.select("l_id", "r_id", "l_grams", "r_grams").dropDuplicates(["l_id", "r_id"]).select("l_id", "r_id", overlap(F.col("l_grams"), F.col("r_grams")).alias("similarity"))
    return found.where(F.col("similarity") > threshold)


#: Names up to which a trigram is a key by itself; of more frequent ones two together are.
RARE = 64

#: Rows under first trigrams for one task, and names with a trigram from which its rows are dealt over cells.
LEAD_ROWS = 200_000

#: Trigrams up to which their order is broadcast.
BROADCAST = 200_000


def _sets(names: DataFrame, blocks: list[str]) -> tuple[DataFrame, int | None]:
    """nr, id, blocks, grams of names, and the least number of trigrams of one; None if there are none."""
    rows = names.select("id", *blocks, trigrams(F.col("name")).alias("grams")).where(F.size("grams") > 0)
    rows = staged(rows.withColumn("nr", F.monotonically_increasing_id()), "sets")
    return rows, rows.agg(F.min(F.size("grams"))).head()[0]


def _least_shared(total: Column, threshold: float) -> Column:
    """Trigrams that two names with so many in all share at least if their similarity is above the threshold."""
    return (F.floor(total * (threshold / (1 + threshold)) - 1e-9) + 1).cast("int")


def _shared_at_least(size: Column, threshold: float, least: int) -> Column:
    """Trigrams that a name of a size shares at least with any name that resembles it and has at least `least` trigrams."""
    return _least_shared(size + F.greatest(F.ceil(size * threshold - 1e-9).cast("int"), F.lit(least)), threshold)


def _ordered(sets: DataFrame, ranks: DataFrame, blocks: list[str], rows: int | None = None) -> DataFrame:
    """nr, blocks, by, size, bits: trigrams of each name as structs of ranks' columns, rare ones first; bits is a bitmap of them.
    Names are dealt by their number before their trigrams are taken apart, so these aren't shuffled if ranks are broadcast."""
    if rows is not None:
        sets = dealt(sets.select("nr", "grams", *blocks), rows, "nr")
    grams = sets.select("nr", *blocks, F.explode("grams").alias("gram")).join(ranks.withColumn("h", F.xxhash64("gram")), "gram")
    own = grams.groupBy("nr", *blocks).agg(F.array_sort(F.collect_list(F.struct(*(c for c in ranks.columns if c != "gram"), "h"))).alias("by"), F.bit_or(F.expr("shiftleft(1L, cast(pmod(h, 64) as int))")).alias("bits"))
    return own.withColumn("size", F.size("by"))


def _keys(sets: DataFrame, ranks: DataFrame, threshold: float, blocks: list[str], least: int, hot: int | None = None) -> DataFrame:
    """nr, size, bits, key: hashes under which a name meets all names that resemble it and have at least `least` trigrams.
    Two names that share k trigrams share two of their first size - k + 2 in any order, so a key is a rare one of these or two
    frequent ones; names so short that a single shared trigram may do have all of theirs. A name has some 65 keys if all of its
    trigrams are frequent, so similar_pairs forms them only in the task that compares them (_meet)."""
    own = _ordered(sets, ranks.select("gram", "n"), blocks).withColumn("block", F.xxhash64(*blocks) if blocks else F.lit(0).cast("long"))
    keep = F.col("size") - _shared_at_least(F.col("size"), threshold, least) + 2
    own = own.withColumn("first", F.slice("by", F.lit(1), F.greatest(F.least(keep, F.col("size")), F.lit(1))))
    often = F.filter("first", lambda g: g["n"] > RARE)
    own = own.withColumns({"often": often, "alone": F.when(F.col("size") * threshold < 1, F.col("by")).otherwise(F.filter("first", lambda g: g["n"] <= RARE))})
    two = F.flatten(F.transform("often", lambda g, i: F.transform(F.slice("often", i + 2, F.size("often")), lambda o: F.xxhash64("block", g["h"], o["h"]))))
    return own.select("nr", "size", "bits", F.explode(F.concat(F.transform("alone", lambda g: F.xxhash64("block", g["h"])), two)).alias("key"))


#: Sides of a cell: rows of LEFT meet those of RIGHT, rows of BOTH each other. Rows of RIGHT are sorted last.
LEFT, BOTH, RIGHT = 0, 1, 2
#: Pairs that a task compares at once.
CHUNK = 1 << 21


def _leads(sets: DataFrame, ranks: DataFrame, threshold: float, blocks: list[str], least: int, hot: int, side: int, rows: int | None, code: str) -> DataFrame:
    """key, nr, bits, note, rest: a row for each trigram of a name that may be the first, in the order of ranks, that it
    shares with a name that resembles it; rest holds those that may be the second. There are a dozen such rows for a name of
    33 trigrams. Rows of a trigram that more than `hot` names have are dealt over the cells of a grid."""
    own = _ordered(sets, ranks, blocks, rows)
    least_shared = _shared_at_least(F.col("size"), threshold, least)
    own = own.withColumns({"last": F.greatest(F.col("size") - least_shared, F.lit(0)), "alone": (least_shared <= 1).cast("int")})
    rest = lambda i: F.transform(F.slice("by", i + 2, F.col("last") - i + 1), lambda g: g["rank"]).cast(f"array<{code}>")
    lead = F.transform(F.slice("by", F.lit(1), F.col("last") + 1), lambda g, i: F.struct(g["rank"].alias("rank"), F.least(F.ceil(g["n"] / max(hot, 1)), F.lit(SALTS)).cast("int").alias("cells"), rest(i).alias("rest")))
    own = own.select("nr", *blocks, "bits", "size", "alone", F.explode(lead).alias("lead")).withColumn("own", F.pmod(F.xxhash64("nr"), F.col("lead.cells")).cast("int"))
    cell = lambda x, y, s: F.struct(x.alias("x"), y.alias("y"), F.lit(s).alias("side"))
    mine, every = F.col("own"), F.sequence(F.lit(0), F.col("lead.cells") - 1)
    if side == LEFT:
        cells = F.transform(every, lambda y: cell(mine, y, LEFT))
    elif side == RIGHT:
        cells = F.transform(every, lambda x: cell(x, mine, RIGHT))
    else:
        cells = F.transform(every, lambda o: F.when(o > mine, cell(mine, o, LEFT)).when(o < mine, cell(o, mine, RIGHT)).otherwise(cell(mine, mine, BOTH)))
    own = own.withColumn("cell", F.explode(cells))
    place = (F.col("lead.rank") * SALTS + F.col("cell.x")) * SALTS + F.col("cell.y")
    key = F.xxhash64(*blocks, place) if blocks else place
    note = (F.col("size") * 4 + F.col("cell.side")) * 2 + F.col("alone")
    return own.select(key.alias("key"), "nr", "bits", note.cast("int").alias("note"), F.col("lead.rest").alias("rest"))


def _meet(threshold: float, once: bool):
    """Pairs l, r of a task's rows (_leads) that share a key, and a second trigram where more than RARE rows have the key, and
    whose bitmaps differ in no more bits than similar names do in trigrams. Names that may share one trigram only meet by
    the key alone. A pair may come several times."""

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = list(batches)
        if not sum(map(len, rows)):
            return
        rows = pa.Table.from_batches(rows)
        key, nr, bits, note = (rows.column(c).to_numpy() for c in ("key", "nr", "bits", "note"))
        lists = rows.column("rest").combine_chunks()
        lengths, codes = lists.value_lengths().to_numpy(zero_copy_only=False), lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        bits, size, side, alone = bits.view(np.uint64), note // 8, note // 2 % 4, note % 2 == 1
        _, group, n = np.unique(key, return_inverse=True, return_counts=True)
        few = n[group] <= RARE
        whole, two = np.flatnonzero(few | alone), np.repeat(np.arange(len(key)), lengths)
        two, codes = two[~few[two]], codes[~few[two]]
        at, under = np.r_[whole, two], np.r_[group[whole] << 32, (group[two] << 32) + codes + 1]
        order = np.lexsort((side[at], under))
        at, under = at[order], under[order]
        place, new = np.arange(len(at)), np.flatnonzero(np.r_[True, under[1:] != under[:-1]])
        ends = np.repeat(np.r_[new[1:], len(at)], np.diff(np.r_[new, len(at)]))
        on_right = np.cumsum(np.r_[0, side[at] == RIGHT])
        firsts = np.where(side[at] == BOTH, place + 1, ends - (on_right[ends] - on_right[place]))
        counts = np.where(side[at] == RIGHT, 0, ends - firsts)
        # in how many trigrams two similar names with so many in all differ at most
        totals = np.arange(2 * int(size.max()) + 1)
        differ = totals - 2 * (np.floor(totals * (threshold / (1 + threshold)) - 1e-9).astype(np.int64) + 1)
        bits_at, before, begin = bits[at], np.r_[0, np.cumsum(counts)], 0
        while begin < len(at):
            end = max(int(np.searchsorted(before, before[begin] + CHUNK, "right")) - 1, begin + 1)
            x = np.repeat(place[begin:end], counts[begin:end])
            y = np.arange(before[begin], before[end]) + np.repeat(firsts[begin:end] - before[begin:end], counts[begin:end])
            near = np.flatnonzero(np.bitwise_count(bits_at[x] ^ bits_at[y]) <= differ.max())
            x, y = at[x[near]], at[y[near]]
            near = np.bitwise_count(bits[x] ^ bits[y]) <= differ[size[x] + size[y]]
            x, y = nr[x[near]], nr[y[near]]
            if len(x):
                yield pa.record_batch({"l": np.minimum(x, y) if once else x, "r": np.maximum(x, y) if once else y})
            begin = end

    return meet


def similar_pairs(left: DataFrame, right: DataFrame, threshold: float, blocks: list[str] | None = None, once: bool = False, hot: int = LEAD_ROWS) -> DataFrame:
    """l_id, r_id, similarity of left(id, name) and right(id, name) with a similarity strictly above the threshold,
    within equal block columns. With once, for a table and itself, only pairs of l_id < r_id are formed. A name is shuffled
    under the first trigrams that it may share, tasks look for a second one, and names that meet are compared by their bitmaps;
    only what is left is written and verified."""
    blocks = blocks or []
    a, least_a = _sets(left, blocks)
    b, least_b = (a, least_a) if once or least_a is None else _sets(right, blocks)
    if least_a is None or least_b is None:
        return left.limit(0).select(F.col("id").alias("l_id")).join(right.limit(0).select(F.col("id").alias("r_id"))).withColumn("similarity", F.lit(0.0))
    ranks = a.select("grams") if once else a.select("grams").unionByName(b.select("grams"))
    ranks = staged(ranks.select(F.explode("grams").alias("gram")).groupBy("gram").agg(F.count("*").alias("n")), "ranks")
    ranks = staged(numbered(ranks, ["n", "gram"], "rank", 0), "ranks").select("n", "rank", "gram")
    known = ranks.count()
    small, code = known <= BROADCAST, "smallint" if known < 1 << 15 else "int"
    ranks = F.broadcast(ranks) if small else ranks
    size, leads, n = F.size("grams"), [], 0
    for rows, least, side in [(a, least_a, BOTH)] if once else [(a, least_b, LEFT), (b, least_a, RIGHT)]:
        first = F.greatest(size - _shared_at_least(size, threshold, least), F.lit(0)) + 1
        grams, firsts = rows.agg(F.sum(size), F.sum(first)).head()
        leads.append(_leads(rows, ranks, threshold, blocks, least, hot, side, grams if small else None, code))
        n += firsts
    tasks = max(-(-n // LEAD_ROWS), min(left.sparkSession.sparkContext.defaultParallelism, -(-n // 1_000)))
    met = staged(reduce(DataFrame.unionByName, leads).repartition(tasks, "key").mapInArrow(_meet(threshold, once), "l long, r long").distinct(), "met")
    p, q = (rows.select(F.col("nr").alias(side), *(F.col(c).alias(f"{side}_{c}") for c in ("id", "grams", *blocks))) for side, rows in (("l", a), ("r", b)))
    both = met.join(p, "l").join(q, "r")
    for c in blocks:
        both = both.where(F.col(f"l_{c}") == F.col(f"r_{c}"))
    found = both.select("l_id", "r_id", overlap(F.col("l_grams"), F.col("r_grams")).alias("similarity")).where(F.col("similarity") > threshold)
    if once:
        found = found.where("l_id <> r_id").select(F.least("l_id", "r_id").alias("l_id"), F.greatest("l_id", "r_id").alias("r_id"), "similarity")
    return found.groupBy("l_id", "r_id").agg(F.max("similarity").alias("similarity"))


class SweepIndex:
    """Pairs of similar names, kept up to date as names come. A store holds the frozen order of trigrams and the rarest
    trigrams of all names so far; add() compares new names with those and with each other."""

    def __init__(self, store: Versions, threshold: float, blocks: list[str] | None = None, hot: int = HOT):
        self.store, self.threshold, self.blocks, self.hot = store, threshold, blocks or [], hot

    def add(self, names: DataFrame) -> DataFrame:
        """id_a < id_b and similarity of new names(id, name, blocks) with known ones and among themselves; they are known
        from now on. Names whose id is known are left out, so adding them again gives nothing."""
        names = names.select("id", "name", *self.blocks)
        if self.store.has("names"):
            names = names.join(self.store.read("names").select("id").distinct(), "id", "left_anti")
        else:
            self.store.commit({"gram_order": gram_order(names)})
        names = staged(names, "names")
        entries = prefixes(names.withColumn("grams", trigrams(F.col("name"))), self.store.read("gram_order"), self.threshold, self.blocks)
        entries = staged(entries, "entries")
        within = _met(entries, entries, self.blocks, self.hot).where("l_id < r_id")
        if self.store.has("names"):
            across = _met(entries, self.store.read("names"), self.blocks, self.hot)
            within = within.unionByName(across.select(within.columns))
        found = staged(_verified(within, self.threshold), "pairs")
        self.store.commit(append={"names": (entries, None)})
        return found.select(F.least("l_id", "r_id").alias("id_a"), F.greatest("l_id", "r_id").alias("id_b"), "similarity")


def best_match(queries: DataFrame, names: DataFrame, threshold: float, blocks: list[str] | None = None) -> DataFrame:
    """l_id, r_id, similarity: the most similar name of each query above the threshold; of ties the smallest id."""
    found = similar_pairs(queries, names, threshold, blocks)
    best = found.groupBy("l_id").agg(F.min(F.struct((-F.col("similarity")).alias("s"), "r_id")).alias("best"))
    return best.select("l_id", "best.r_id", (-F.col("best.s")).alias("similarity"))


def duplicate_pairs(names: DataFrame, threshold: float, blocks: list[str] | None = None, queue: DataFrame | None = None) -> DataFrame:
    """id_a < id_b and similarity of names alike; pairs of queue(id_a, id_b), in either order, are left out."""
    found = similar_pairs(names, names, threshold, blocks, once=True).select(F.col("l_id").alias("id_a"), F.col("r_id").alias("id_b"), "similarity")
    if queue is None:
        return found
    known = queue.select(F.least("id_a", "id_b").alias("id_a"), F.greatest("id_a", "id_b").alias("id_b"))
    return found.join(known, ["id_a", "id_b"], "left_anti")
