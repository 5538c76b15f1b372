"""Prefix trie of conversations by the Euler-tour technique.

Every distinct sequence of first turns is a node. Each node has an arc that enters it and one that leaves it; the tour
passes all arcs in depth-first order. Ranking the tour gives every arc its position, and a sum over a subtree is the
difference of two prefix sums, at the positions of its node's arcs. Work never follows the depth of the trie:

- positions of turns come from a range-partitioned sort (``placed``), prefixes are told apart by the exclusive or of
  128-bit hashes of (position, turn), which adds up block by block;
- a node is named by its smallest member and its depth. The nodes that one conversation names form a chain, whose
  enter arcs lie together in the tour, and so do its exit arcs between two depths where other chains branch off. Such a
  stretch of arcs is one item of the list, so the list has at most three items for each chain;
- the list is ranked by pointer doubling: each round joins the items with their successors, so distances double;
- prefix sums over arc positions go by blocks of consecutive positions.

All steps but the digests are DataFrame operations. Digests are made from sorted blocks of ids, one batch at a time.

Defined results: rows without conv_id take no part. Turns are ordered by turn, null first; turns with the same number by
the MD5 of role, a line feed and text. A null role or text is empty. Repeated rows are turns of their own. An empty
table has no nodes. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from airlattice.llm.common import col, discard, row_type, stored

#: Rows of a block of prefix sums; ids of one digest block.
BLOCK = 1 << 14


def placed(df: DataFrame, order: list[Column], what: str) -> DataFrame:
    """The rows in one global order, stored: ``part`` is the range a row lies in, ``at`` its place there, from 0.

    Ranges are those of Spark's range partitioning. ``order`` must tell all rows apart, up to rows that are equal.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *order).withColumn("part", F.spark_partition_id())
    return stored(ranged, what).withColumn("at", F.row_number().over(Window.partitionBy("part").orderBy(*order)) - 1)


def beside(rows: DataFrame, step: int, columns: list[str], prefix: str) -> DataFrame:
    """``columns`` of the row before (step -1) or after (step 1) in the order of ``placed``; null at the ends.

    Inside a range by a window; across ranges from one edge row each, so the broadcast has at most one row for each range.
    """
    one = Window.partitionBy("part").orderBy("at")
    value = F.struct(*columns)
    near = F.lag(value).over(one) if step < 0 else F.lead(value).over(one)
    seen = rows.withColumn("near", near)
    if step < 0:
        edges = rows.withColumn("edge", F.lead("at").over(one).isNull()).where("edge")
    else:
        edges = rows.where("at = 0")
    over = Window.orderBy("part")
    jump = F.lag(value).over(over) if step < 0 else F.lead(value).over(over)
    edges = F.broadcast(edges.select("part", jump.alias("jump")))
    found = seen.join(edges, "part").withColumn("near", F.coalesce("near", "jump"))
    return found.select(*rows.columns, *[F.col("near").getField(c).alias(prefix + c) for c in columns])


def running(rows: DataFrame, keys: list[str], at: str, values: dict[str, Column], total, last=None, block: int = BLOCK,
            descending: bool = False) -> DataFrame:
    """Running totals along ``at`` inside ``keys``, by blocks of ``at``: a window in a block, and one over the blocks' totals.

    ``total`` is the aggregate of values and of totals, ``last`` what joins the total before a block and the one in it.
    """
    rows = rows.withColumn("_block", F.floor(F.col(at) / block))
    order = (lambda c: F.desc(c)) if descending else F.col
    inside = Window.partitionBy(*keys, "_block").orderBy(order(at)).rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy(*keys).orderBy(order("_block")).rowsBetween(Window.unboundedPreceding, -1)
    whole = rows.groupBy(*keys, "_block").agg(*[total(v).alias(f"_{n}") for n, v in values.items()])
    before = whole.select(*keys, "_block", *[total(F.col(f"_{n}")).over(earlier).alias(f"_{n}") for n in values])
    here = rows.withColumns({n: total(v).over(inside) for n, v in values.items()})
    joined = here.join(before, [*keys, "_block"])
    return joined.withColumns({n: last(F.col(f"_{n}"), F.col(n)) for n in values}).drop("_block", *[f"_{n}" for n in values])


def ordered_turns(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, pos, mark, bytes): turns by position from 1, with a fingerprint of role and text and the bytes of the text."""
    text_, role_ = (F.coalesce(col(c).cast("string"), F.lit("")) for c in (text, role))
    turns = conversations.where(col(conv_id).isNotNull()).select(
        col(conv_id).cast("long").alias("conv"), col(turn).cast("long").alias("turn"),
        F.md5(F.encode(F.concat(role_, F.lit("\n"), text_), "UTF-8")).alias("tie"), F.xxhash64(role_, text_).alias("mark"),
        F.octet_length(text_).cast("long").alias("bytes"), F.monotonically_increasing_id().alias("row"))
    order = [F.col("conv"), F.asc_nulls_first("turn"), F.col("tie"), F.col("mark"), F.col("row")]
    rows = placed(turns, order, "turns")
    # A conversation that spans ranges is the last of one and the first of the next: one offset for each range and conversation.
    counts = rows.groupBy("conv", "part").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("conv", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    own = F.row_number().over(Window.partitionBy("conv", "part").orderBy("at"))
    return (rows.withColumn("own", own).join(offsets, ["conv", "part"])
            .select("conv", (F.col("own") + F.col("offset")).alias("pos"), F.xxhash64("tie", "mark").alias("mark"), "bytes"))


def rebuild(turns: DataFrame, group: int = 5, most: int = 9) -> DataFrame:
    """(conv, depth, mark, bytes), and a row of depth 0 for each conversation.

    Conversation c gets the first h = crc32(c) % ``most`` turns of conversation c - c % ``group``, then its own after the
    first h. Only the first ``most`` - 1 turns of a conversation are ever copied.
    """
    convs = turns.groupBy("conv").agg(F.count("*").alias("n"))
    convs = convs.select("conv", (F.col("conv") - F.col("conv") % group).alias("base"), (F.crc32(F.encode(F.col("conv").cast("string"), "UTF-8")) % most).alias("h"))
    heads = turns.where(F.col("pos") < most).withColumnsRenamed({"conv": "base"})
    copied = convs.where("base <> conv").join(heads, "base").where("pos <= h").select("conv", F.col("pos").alias("depth"), "mark", "bytes")
    given = copied.groupBy("conv").agg(F.count("*").alias("given"))
    own = convs.where("base <> conv").join(given, "conv", "left").select("conv", "h", F.coalesce("given", F.lit(0)).alias("given"))
    kept = turns.join(own, "conv", "left").where("h IS NULL OR pos > h").select(
        "conv", F.when(F.col("h").isNull(), F.col("pos")).otherwise(F.col("pos") - F.col("h") + F.col("given")).alias("depth"), "mark", "bytes")
    root = convs.select("conv", F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("mark"), F.lit(0).cast("long").alias("bytes"))
    return kept.unionByName(copied).unionByName(root)


def prefixes(rebuilt: DataFrame) -> DataFrame:
    """(conv, depth, bytes, x, y, ux, uy): 128 bits of the first ``depth`` turns, and of one turn fewer."""
    at = F.struct("depth", "mark")
    marked = rebuilt.withColumns({"mx": F.xxhash64(F.lit(1), at), "my": F.xxhash64(F.lit(2), at)})
    both = running(marked, ["conv"], "depth", {"x": F.col("mx"), "y": F.col("my")}, F.bit_xor,
                   lambda before, here: F.coalesce(before, F.lit(0)).bitwiseXOR(here))
    return both.select("conv", "depth", "bytes", "x", "y", F.col("x").bitwiseXOR(F.col("mx")).alias("ux"), F.col("y").bitwiseXOR(F.col("my")).alias("uy"))


def rank_list(items: DataFrame, size: int) -> DataFrame:
    """(conv, hi, left): the summed weight from an item to the end of the list, its own included.

    ``items`` are (conv, hi, weight, next_conv, next_hi); the last has no next. Each round is stored, so a lost
    executor repeats one join; items that have reached the end are set apart and only read as successors.
    """
    now = items.select("conv", "hi", F.col("weight").alias("left"), "next_conv", "next_hi")
    reach = 1
    while reach < size:
        after = now.select(F.col("conv").alias("next_conv"), F.col("hi").alias("next_hi"), F.col("left").alias("far"),
                           F.col("next_conv").alias("far_conv"), F.col("next_hi").alias("far_hi"))
        moved = now.where("next_conv IS NOT NULL").join(after, ["next_conv", "next_hi"]).select(
            "conv", "hi", (F.col("left") + F.col("far")).alias("left"), F.col("far_conv").alias("next_conv"), F.col("far_hi").alias("next_hi"))
        done, now = now, stored(moved.unionByName(now.where("next_conv IS NULL")), "ranks")
        if reach > 1:
            discard(done)
        reach *= 2
    return now.select("conv", "hi", "left")


def digests(members: DataFrame) -> DataFrame:
    """(conv, depth, ends_sha256) from (conv, depth, member): SHA-256 of the members' decimals, ascending, comma-joined.

    Ids are joined to strings of up to ``BLOCK`` by tasks of their own; a node's strings then pass one task in order, which
    only hashes them and keeps one state.
    """
    rows = placed(members, [F.col("conv"), F.col("depth"), F.col("member")], "members")
    strings = (rows.withColumn("cut", F.floor(F.col("at") / BLOCK)).groupBy("conv", "depth", "part", "cut")
               .agg(F.array_join(F.array_sort(F.collect_list("member")).cast("array<string>"), ",").alias("ids")))
    n = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ready = strings.repartition(n, "conv", "depth").sortWithinPartitions("conv", "depth", "part", "cut")
    schema = pa.schema([("conv", pa.int64()), ("depth", pa.int64()), ("ends_sha256", pa.string())])

    def hash_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for batch in batches:
            done = []
            for conv, depth, ids in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("conv", "depth", "ids"))):
                if (conv, depth) != now:
                    if now:
                        done.append((*now, state.hexdigest()))
                    now, state = (conv, depth), hashlib.sha256(ids.encode())
                else:
                    state.update(f",{ids}".encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), schema)], schema=schema)
        if now:
            yield pa.RecordBatch.from_arrays([pa.array([c], f.type) for c, f in zip((*now, state.hexdigest()), schema)], schema=schema)

    return ready.select("conv", "depth", "ids").mapInArrow(hash_all, row_type("conv long, depth long, ends_sha256 string"))


def chains_of(nodes: DataFrame) -> DataFrame:
    """(conv, top, end, parent, under): the depths that a conversation names, and the node (parent, under) above them.

    The root's chain has no parent and under -1.
    """
    spans = nodes.groupBy("conv").agg(F.min("depth").alias("top"), F.max("depth").alias("end"))
    tops = nodes.select("conv", F.col("depth").alias("top"), "ux", "uy").join(spans, ["conv", "top"])
    above = nodes.select((F.col("depth") + 1).alias("top"), F.col("x").alias("ux"), F.col("y").alias("uy"), F.col("conv").alias("parent"))
    return tops.join(above, ["top", "ux", "uy"], "left").select("conv", "top", "end", "parent", (F.col("top") - 1).alias("under"))


def tour_items(chains: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The items of the tour, and the branches: (conv, hi, first, n_chains), nodes with chains that hang below them.

    Item (c, -1) holds the enter arcs of chain c from the top down, item (c, hi) its exit arcs from depth ``hi`` up to
    below the next branch. Chains below a node are visited by conversation, after the chain of the node itself.
    """
    order = [F.asc_nulls_first("parent"), F.col("under"), F.col("conv")]
    rows = placed(chains, order, "chains")
    rows = beside(beside(rows, -1, ["parent", "under"], "before_"), 1, ["parent", "under", "conv"], "after_")
    together = lambda p: F.coalesce((F.col("parent") == F.col(f"{p}_parent")) & (F.col("under") == F.col(f"{p}_under")), F.lit(False))
    rows = stored(rows.select("conv", "top", "end", "parent", "under", (~together("before")).alias("opens"),
                              F.when(F.col("before_parent") == F.col("parent"), F.col("before_under")).alias("lower"),
                              F.when(together("after"), F.col("after_conv")).alias("sibling")), "siblings")
    below = rows.where("parent IS NOT NULL")
    firsts = below.where("opens").select(F.col("parent").alias("conv"), F.col("under").alias("hi"), F.col("conv").alias("first"), "lower")
    hung = below.groupBy(F.col("parent").alias("conv"), F.col("under").alias("hi")).agg(F.count("*").alias("n_chains"))
    branches = stored(firsts.join(hung, ["conv", "hi"]), "branches")
    deepest = branches.groupBy("conv").agg(F.max("hi").alias("lower"))
    ends = rows.select("conv", F.col("end").alias("hi")).join(deepest, "conv", "left").where("lower IS NULL OR lower < hi")
    chain = rows.select("conv", "top", "parent", "under", "sibling")
    first_below = branches.select("conv", F.col("hi").alias("lower"), F.col("first").alias("next_first"))
    leave = ends.unionByName(branches.select("conv", "hi", "lower")).join(chain, "conv").join(first_below, ["conv", "lower"], "left").select(
        "conv", "hi", (F.col("hi") - F.coalesce(F.col("lower") + 1, F.col("top")) + 1).alias("weight"),
        F.coalesce("next_first", "sibling", "parent").alias("next_conv"),
        F.when(F.coalesce("next_first", "sibling").isNotNull(), F.lit(-1).cast("long")).otherwise(
            F.when(F.col("parent").isNotNull(), F.col("under"))).alias("next_hi"))
    at_end = branches.select("conv", F.col("hi").alias("end"), "first")
    enter = rows.join(at_end, ["conv", "end"], "left").select(
        "conv", F.lit(-1).cast("long").alias("hi"), (F.col("end") - F.col("top") + 1).alias("weight"),
        F.coalesce("first", "conv").alias("next_conv"), F.when(F.col("first").isNotNull(), F.lit(-1).cast("long")).otherwise(F.col("end")).alias("next_hi"))
    return enter.unionByName(leave), branches


def prefix_trie(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                group: int = 5, most: int = 9) -> DataFrame:
    """One row for each node of the trie of the rebuilt conversations; columns as in the contract of op13."""
    turns = stored(ordered_turns(conversations, conv_id, turn, role, text), "ordered")
    paths = stored(prefixes(rebuild(turns, group, most)), "prefixes")
    nodes = stored(paths.groupBy("depth", "x", "y").agg(
        F.min("conv").alias("conv"), F.count("*").alias("n_convs"), F.min("bytes").alias("bytes"), F.min("ux").alias("ux"), F.min("uy").alias("uy")), "nodes")
    chains = stored(chains_of(nodes), "chains")
    items, branches = tour_items(chains)
    items = stored(items, "items")
    arcs = 2 * nodes.count()
    ranks = rank_list(items, items.count()).select("conv", "hi", (F.lit(arcs) - F.col("left")).alias("start"))

    spans = chains.select("conv", "top", "end", "parent")
    known = (nodes.join(spans, "conv").join(branches.select("conv", F.col("hi").alias("depth"), "n_chains"), ["conv", "depth"], "left")
             .withColumn("n_children", F.coalesce("n_chains", F.lit(0)) + (F.col("depth") < F.col("end")).cast("long"))
             .withColumn("saved", (F.col("n_convs") - 1) * F.col("bytes"))
             .withColumn("parent_conv_id", F.when(F.col("depth") > F.col("top"), F.col("conv")).otherwise(F.col("parent")))
             .withColumn("opens", F.when((F.col("depth") == F.col("end")) | F.col("n_chains").isNotNull(), F.col("depth"))))
    known = stored(running(known, ["conv"], "depth", {"hi": F.col("opens")}, F.min, lambda before, here: F.coalesce(here, before), descending=True)
                   .select("conv", "depth", "top", "hi", "parent_conv_id", "n_convs", "n_children", "saved"), "known")
    entered = known.join(ranks.where("hi = -1").select("conv", "start"), "conv").select(
        "conv", "depth", F.lit(False).alias("leaves"), (F.col("start") + F.col("depth") - F.col("top")).alias("pos"),
        (F.col("n_children") == 0).cast("long").alias("leaf"), "saved")
    nothing = F.lit(0).cast("long")
    left = known.join(ranks.where("hi >= 0"), ["conv", "hi"]).select(
        "conv", "depth", F.lit(True).alias("leaves"), (F.col("start") + F.col("hi") - F.col("depth")).alias("pos"), nothing.alias("leaf"), nothing.alias("saved"))
    tour = entered.unionByName(left).withColumns({"sum_leaf": F.col("leaf"), "sum_saved": F.col("saved")})
    sums = running(tour, [], "pos", {"sum_leaf": F.col("leaf"), "sum_saved": F.col("saved")}, F.sum, lambda before, here: F.coalesce(before, nothing) + here)
    under = lambda what: F.sum(F.when(F.col("leaves"), F.col(f"sum_{what}")).otherwise(F.col(what) - F.col(f"sum_{what}")))
    subtrees = sums.groupBy("conv", "depth").agg(under("leaf").alias("n_leaves"), under("saved").alias("saved_tokens"))

    lengths = paths.groupBy("conv").agg(F.max("depth").alias("depth"))
    members = (paths.join(lengths, ["conv", "depth"]).select(F.col("conv").alias("member"), "depth", "x", "y")
               .join(nodes.select("depth", "x", "y", "conv"), ["depth", "x", "y"]).select("conv", "depth", "member"))
    return (known.join(subtrees, ["conv", "depth"]).join(digests(members), ["conv", "depth"], "left").select(
        F.col("conv").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256")))
