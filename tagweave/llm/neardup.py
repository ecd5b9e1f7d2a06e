"""Near duplicates by SetSketch registers, banding, likelihood and full verification.

1. One pass over the texts gives each document the size and a 128-bit hash of its
   set of word shingles, and a sketch: for each register the smallest of the
   shingles' random values, kept on an exponential scale in one byte. Registers of
   a union are the larger ones of its parts. Equal sets form a class.
2. Groups of registers (bands) of the classes' sketches are hashed. Classes that
   share a band are candidates. At the threshold a pair shares none of the 42 bands
   of 5 with probability below 1e-7.
3. First each class is compared with the smallest of its band, so that a band of g
   members makes g - 1 candidates. The Jaccard similarity of a candidate is
   estimated from its registers by maximum likelihood; it is passed over only where
   the threshold is less likely than the estimate by a factor of e^12. The others
   are checked on their full sets.
4. Links join classes to components. In bands that still hold several components, all
   others are compared with every member of the one with most members and with each
   other, in blocks of bounded size and on full sets inside a task, which returns one
   link at most for each member and component. Bands without a component of several
   members are compared sketch by sketch, in blocks too, and what passes is checked
   on full sets as well. Rows between tasks grow with members and not with pairs.

A link is lost only by the two chances named: no common band (below 1e-7 at the threshold),
or registers that speak against it by e^12 (about 5e-7 at the threshold, from the
likelihood ratio's distribution), each less for more similar pairs.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tagweave.llm.common import (
    LOWER, flat, mixed, pair_hashes, small_batches, span_hashes, staged, word_bounds)
from tagweave.llm.components import components

BANDS, BAND_ROWS = 42, 5
REGISTERS = BANDS * BAND_ROWS
#: Scale of the registers: values fall by this factor from one step to the next.
SPACING = 1.1
#: Log likelihood by which the threshold may fall short of the best estimate.
MARGIN = 12.0
#: Members of a band that are compared with each other in one block, and shingles of a
#: component's members in one.
BLOCK, BLOCK_SHINGLES = 512, 1_000_000
#: Members that one copy of a band leader's text serves.
SERVED = 2000
LOWEST = -(1 << 63)
_FACTORS = (np.random.default_rng(77).integers(0, 1 << 31, REGISTERS, np.uint32) << 1) | 1


@dataclass(frozen=True)
class Rule:
    """Shingles of so many words; links where 100 |A n B| >= percent |A u B|."""

    words: int = 5
    percent: int = 80


def shingles(data: np.ndarray, rows: np.ndarray, size: int) -> list[np.ndarray]:
    """Per row the sorted distinct hashes of its word shingles.

    Fewer words than ``size`` are one shingle, none are the empty set.
    """
    data = LOWER[data]
    starts, ends, first = word_bounds(data, rows)
    words = span_hashes(data, starts, ends)
    found = []
    for k in range(len(rows) - 1):
        own = words[first[k]:first[k + 1]]
        if not len(own):
            found.append(own)
            continue
        steps = min(size, len(own)) - 1
        for _ in range(steps):
            own = pair_hashes(own)
        found.append(np.unique(own if steps == size - 1 else mixed(own ^ np.uint64(steps + 1))))
    return found


def sketch(hashes: np.ndarray) -> np.ndarray:
    """One byte for each register: the step of the smallest value, larger for smaller values."""
    least = np.full(REGISTERS, np.uint32(0xFFFFFFFF))
    values = (hashes >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(values), 512):
        np.minimum(least, (values[at:at + 512, None] * _FACTORS).min(axis=0), out=least)
    waits = -np.log1p(-(least.astype(float) + 0.5) / 2.0**32)
    return np.clip(np.floor(34 - np.log(waits) / np.log(SPACING)), 0, 255).astype(np.uint8)


_GRID = np.linspace(0, 1, 101)


def _steps(x: np.ndarray) -> np.ndarray:
    return -np.log1p(-x * (SPACING - 1) / SPACING) / np.log(SPACING)


def plausible(a: np.ndarray, b: np.ndarray, sizes_a, sizes_b, percent: int) -> np.ndarray:
    """Which pairs of sketches (rows) may reach the threshold.

    The counts of larger, smaller and equal registers have a likelihood for each
    similarity on a grid, given the sizes of the sets.
    """
    sizes_a, sizes_b = np.asarray(sizes_a, float), np.asarray(sizes_b, float)
    above = (a > b).sum(axis=1)[:, None]
    below = (a < b).sum(axis=1)[:, None]
    same = a.shape[1] - above - below
    share = (sizes_a / (sizes_a + sizes_b))[:, None]
    up = np.clip(_steps(np.clip(share - (1 - share) * _GRID, 0, 1)), 1e-6, 1)
    down = np.clip(_steps(np.clip(1 - share - share * _GRID, 0, 1)), 1e-6, 1)
    equal = np.clip(1 - up - down, 1e-6, 1)
    fit = above * np.log(up) + below * np.log(down) + same * np.log(equal)
    near = fit[:, _GRID >= percent / 100 - 0.005].max(axis=1)
    small, large = np.minimum(sizes_a, sizes_b), np.maximum(sizes_a, sizes_b)
    return (near >= fit.max(axis=1) - MARGIN) & (100 * small >= percent * large)


def sketched(docs: DataFrame, rule: Rule) -> DataFrame:
    """(id, h, n, s1, s2, sketch) per row: set size, set hash and registers."""

    def passes(batches):
        for batch in batches:
            ids, h = batch.column(0), batch.column(1)
            sets = shingles(*flat(batch.column(2)), rule.words)
            n = [len(s) for s in sets]
            sums = [(int(mixed(s).sum().view(np.int64)),
                     int(mixed(s ^ np.uint64(0x5851F42D4C957F2D)).sum().view(np.int64)))
                    if len(s) else (0, 0) for s in sets]
            registers = [sketch(s).tobytes() if len(s) else b"" for s in sets]
            yield pa.RecordBatch.from_arrays(
                [ids, h, pa.array(n, pa.int64()), pa.array([s for s, _ in sums], pa.int64()),
                 pa.array([s for _, s in sums], pa.int64()), pa.array(registers, pa.binary())],
                names=["id", "h", "n", "s1", "s2", "sketch"])

    return docs.mapInArrow(passes, "id long, h long, n long, s1 long, s2 long, sketch binary")


def _bands(classes: DataFrame) -> DataFrame:
    """(key, node) for every band of every class."""
    keys = [F.xxhash64(F.lit(i), F.substring("sketch", i * BAND_ROWS + 1, BAND_ROWS))
            for i in range(BANDS)]
    return classes.select("node", F.explode(F.array(*keys)).alias("key"))


def _with_sketches(pairs: DataFrame, classes: DataFrame, rule: Rule) -> DataFrame:
    """Pairs (a, b) that their sketches don't rule out."""
    of = {c: classes.select(F.col("node").alias(c), F.col("n").alias(f"n_{c}"),
                            F.col("sketch").alias(f"s_{c}")) for c in "ab"}
    near = (pairs.join(of["a"], "a").join(of["b"], "b")
            .filter(100 * F.least("n_a", "n_b") >= rule.percent * F.greatest("n_a", "n_b")))

    def passes(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            at = {c: batch.column(i) for i, c in enumerate(batch.schema.names)}
            a, b = (flat(at[c])[0].reshape(-1, REGISTERS) for c in ("s_a", "s_b"))
            ok = plausible(a, b, at["n_a"].to_numpy(), at["n_b"].to_numpy(), rule.percent)
            yield pa.RecordBatch.from_arrays([at["a"], at["b"]], names=["a", "b"]).filter(
                pa.array(ok))

    kind = pairs.schema["a"].dataType.simpleString()
    return near.select("a", "b", "n_a", "n_b", "s_a", "s_b").mapInArrow(
        passes, f"a {kind}, b {kind}")


def _texts(docs: DataFrame, members: DataFrame) -> DataFrame:
    """(node, text) of all candidates, written once; there are too many to broadcast."""
    wanted = members.select("node").distinct().hint("merge")
    return staged(docs.select(F.struct("id", "h").alias("node"), "text")
                  .join(wanted, "node", "left_semi")
                  .groupBy("node").agg(F.first("text").alias("text")), "texts")


def _verified(pairs: DataFrame, texts: DataFrame, rule: Rule) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold.

    The text of ``a`` comes once for every SERVED partners and is followed by theirs;
    a task holds one of them and a batch of the others.
    """
    copies = pairs.groupBy("a").agg((1 + F.floor(F.count("*") / SERVED)).cast("int")
                                    .alias("copies"))
    first = (copies.join(texts, F.col("a") == F.col("node"))
             .select("a", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy"),
                     F.lit(0).alias("kind"), F.col("a").alias("b"), "text"))
    other = (pairs.join(copies, "a").join(texts, F.col("b") == F.col("node"))
             .select("a", F.pmod(F.xxhash64("b"), F.col("copies")).cast("int").alias("copy"),
                     F.lit(1).alias("kind"), "b", "text"))
    parts = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = (first.unionByName(other).repartition(parts, "a", "copy")
             .sortWithinPartitions("a", "copy", "kind")
             .select("a", "b", "kind", "text"))

    def passes(batches):
        held = np.zeros(0, np.uint64)
        for batch in batches:
            sets = shingles(*flat(batch.column(3)), rule.words)
            linked = np.zeros(len(sets), bool)
            for k, (kind, own) in enumerate(zip(batch.column(2).to_pylist(), sets)):
                if kind == 0:
                    held = own
                    continue
                linked[k] = _linked(held, own, rule)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(linked))

    kind = pairs.schema["a"].dataType.simpleString()
    return dealt.mapInArrow(passes, f"a {kind}, b {kind}")


def _open_bands(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows (key, node, part) of bands that hold several components, with the one that
    has most members in the band (``major``) and how many those are (``majors``)."""
    placed = (members.join(labels.withColumnRenamed("component", "part"), "node", "left")
              .select("key", "node", F.coalesce("part", "node").alias("part")))
    bands = (placed.groupBy("key", "part").agg(F.count("*").alias("n"))
             .groupBy("key").agg(F.max(F.struct("n", "part")).alias("most"),
                                 F.count("*").alias("parts"), F.sum("n").alias("size"))
             .filter((F.col("parts") > 1) & (F.col("size") > 2))
             .select("key", "size", F.col("most.part").alias("major"),
                     F.col("most.n").alias("majors")))
    return placed.join(bands, "key")


def _joining(open_: DataFrame, labels: DataFrame, classes: DataFrame, texts: DataFrame,
             rule: Rule) -> DataFrame:
    """Links (a, b) of members that lie in a band beside a component of several members.

    The component's members and all that lie beside it are dealt to blocks once; the
    latter also come to each block and are compared with what lies there. Full sets
    are compared inside the task, most similar sketches first, until one of each
    component known so far links; so rows grow with members, not with pairs.
    """
    strays = (open_.filter((F.col("majors") > 1) & (F.col("part") != F.col("major")))
              .select("node", "part", F.col("major").alias("component")).distinct())
    near = strays.select("component").distinct()
    held = labels.join(near, "component").select(
        "component", "node", F.col("component").alias("part")).unionByName(
            strays.select("component", "node", "part"))
    sizes = (held.join(classes.select("node", "n"), "node").groupBy("component")
             .agg((1 + F.floor(F.sum("n") / BLOCK_SHINGLES)).cast("int").alias("blocks")))
    known = held.join(sizes, "component").select(
        "component", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("block"),
        F.lit(0).alias("kind"), "node", "part")
    asked = strays.join(sizes, "component").select(
        "component", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
        F.lit(1).alias("kind"), "node", "part")
    rows = known.unionByName(asked)
    parts = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = (rows.join(classes.select("node", "n", "sketch"), "node").join(texts, "node")
             .repartition(parts, "component", "block")
             .sortWithinPartitions("component", "block", "kind")
             .select(F.xxhash64("component", "block").alias("at"), "kind", "node", "n", "sketch",
                     "text", F.xxhash64("part").alias("part")))

    def passes(batches):
        at, nodes, sizes_, registers, sets, parts_ = None, [], [], [], [], []
        for batch in batches:
            where, kind, n, part = (batch.column(c).to_numpy()
                                    for c in ("at", "kind", "n", "part"))
            names = batch.column("node").to_pylist()
            own = flat(batch.column("sketch"))[0].reshape(-1, REGISTERS)
            full = shingles(*flat(batch.column("text")), rule.words)
            left, right = [], []
            for k in range(len(n)):
                if where[k] != at:
                    at, nodes, sizes_, registers, sets, parts_ = where[k], [], [], [], [], []
                if kind[k] == 0:
                    nodes.append(names[k])
                    sizes_.append(n[k])
                    registers.append(own[k].copy())
                    sets.append(full[k])
                    parts_.append(part[k])
                    continue
                if isinstance(registers, list):
                    registers, sizes_ = np.array(registers).reshape(-1, REGISTERS), np.array(sizes_)
                    parts_ = np.array(parts_)
                near = np.flatnonzero((100 * np.minimum(sizes_, n[k])
                                       >= rule.percent * np.maximum(sizes_, n[k]))
                                      & (parts_ != part[k]))
                if not len(near):
                    continue
                near = near[plausible(np.broadcast_to(own[k], (len(near), REGISTERS)),
                                      registers[near], np.full(len(near), n[k]), sizes_[near],
                                      rule.percent)]
                alike = (registers[near] == own[k]).sum(axis=1)
                met = set()
                for m in near[np.argsort(-alike, kind="stable")]:
                    if parts_[m] not in met and _linked(sets[m], full[k], rule):
                        met.add(parts_[m])
                        left.append(nodes[m])
                        right.append(names[k])
            if left:
                kind_ = batch.schema.field("node").type
                yield pa.RecordBatch.from_arrays(
                    [pa.array(left, kind_), pa.array(right, kind_)], names=["a", "b"])

    kind = classes.schema["node"].dataType.simpleString()
    return dealt.mapInArrow(passes, f"a {kind}, b {kind}")


def _linked(a: np.ndarray, b: np.ndarray, rule: Rule) -> bool:
    both = np.concatenate([a, b])
    both.sort()
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= rule.percent * (len(both) - common)


def _across(open_: DataFrame, classes: DataFrame, rule: Rule) -> DataFrame:
    """Pairs in bands of which no component has several members, as far as sketches don't
    rule them out, in blocks of bounded size. ``_joining`` compares in the other bands.
    """
    rest = open_.filter("majors = 1")
    sizes = rest.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1").select(
        "key", (1 + F.floor(F.col("size") / BLOCK)).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    rows = (rest.select("key", "node", "part").join(sizes, "key").withColumn("own", own)
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select("key", F.least("own", "other").alias("i"),
                    F.greatest("own", "other").alias("j"), "own", "node", "part")
            .join(classes.select("node", "n", "sketch"), "node"))
    parts = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = (rows.repartition(parts, "key", "i", "j")
             .select("key", "i", "j", "own", "node", F.xxhash64("part").alias("part"), "n",
                     "sketch")
             .sortWithinPartitions("key", "i", "j"))

    def pairs_of(table: pa.Table):
        n, part, own = (table.column(c).to_numpy() for c in ("n", "part", "own"))
        i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        registers = flat(table.column("sketch"))[0].reshape(-1, REGISTERS)
        left, right = [], []
        for k in range(len(n)):
            later = np.arange(k + 1, len(n))
            later = later[(part[later] != part[k])
                          & (100 * np.minimum(n[later], n[k])
                             >= rule.percent * np.maximum(n[later], n[k]))]
            if i != j:
                later = later[own[later] != own[k]]
            if len(later):
                near = plausible(np.broadcast_to(registers[k], (len(later), REGISTERS)),
                                 registers[later], np.full(len(later), n[k]), n[later],
                                 rule.percent)
                right += later[near].tolist()
                left += [k] * int(near.sum())
        nodes = table.column("node").combine_chunks()
        return nodes.take(pa.array(left, pa.int64())), nodes.take(pa.array(right, pa.int64()))

    def passes(batches):
        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([rest, table]) if rest is not None else table
            keys = [table.column(c).to_numpy() for c in ("key", "i", "j")]
            edges = np.flatnonzero(sum((np.diff(x) != 0) for x in keys)) + 1
            bounds = [0, *edges.tolist()]
            for a, b in zip(bounds, bounds[1:]):
                x, y = pairs_of(table.slice(a, b - a))
                if len(x):
                    yield pa.RecordBatch.from_arrays([x, y], names=["a", "b"])
            rest = table.slice(bounds[-1])
        if rest is not None and rest.num_rows:
            x, y = pairs_of(rest)
            if len(x):
                yield pa.RecordBatch.from_arrays([x, y], names=["a", "b"])

    kind = classes.schema["node"].dataType.simpleString()
    found = dealt.mapInArrow(passes, f"a {kind}, b {kind}")
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def near_duplicates(docs: DataFrame, rule: Rule = Rule(), id_column: str = "doc_id",
                    text_column: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id, kept, and the text's hash ``h``.

    A component is what links reach; its id is the smallest doc_id in it, and
    ``kept`` marks rows of that id. Rows without words are linked with nothing.
    Rows that repeat an id are documents of their own; copies of the kept row that
    share its id are kept as well. A null id counts as smaller than all others.
    """
    spark = docs.sparkSession
    small_batches(spark)
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    given = docs.select(F.coalesce(F.col(id_column).cast("long"), F.lit(LOWEST)).alias("id"),
                        F.xxhash64(text).alias("h"), text.alias("text"))
    rows = staged(sketched(given, rule), "sketches")
    classes = staged(
        rows.filter("n > 0").groupBy("n", "s1", "s2").agg(
            F.min(F.struct("id", "h")).alias("node"), F.first("sketch").alias("sketch")),
        "classes")

    banded = _bands(classes)
    leaders = (banded.groupBy("key").agg(F.min("node").alias("a"), F.count("*").alias("size"))
               .filter("size > 1"))
    members = staged(banded.join(leaders, "key"), "bands")
    first = (members.filter(F.col("a") != F.col("node"))
             .select("a", F.col("node").alias("b")).distinct())
    first = staged(_with_sketches(first, classes, rule), "candidates")
    texts = _texts(given, members)
    links = staged(_verified(first, texts, rule), "links")

    labels = components(links)
    several = staged(members.filter("size > 2").select("key", "node"), "several")
    open_ = staged(_open_bands(several, labels), "open-bands")
    links = links.unionByName(staged(_joining(open_, labels, classes, texts, rule), "links"))
    more = staged(_across(open_, classes, rule).join(first, ["a", "b"], "left_anti"),
                  "candidates")
    links = links.unionByName(staged(_verified(more, texts, rule), "links"))
    labels = components(links)

    placed = classes.join(labels, "node", "left").select(
        "n", "s1", "s2", F.coalesce("component", "node")["id"].alias("component"))
    known = rows.drop("sketch").join(placed, ["n", "s1", "s2"], "left")
    component = F.coalesce("component", "id")
    return known.select(
        F.when(F.col("id") != LOWEST, F.col("id")).alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.when(component != LOWEST, component).alias("component_id"),
        (F.col("id") == component).alias("kept"), "h")
