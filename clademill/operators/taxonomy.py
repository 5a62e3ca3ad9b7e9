"""Taxonomies as tables: every node carries its path from the root.

With paths, containment is one array lookup (the ancestor of a node at depth d is element d of its path), a common
ancestor is a common prefix, and a roll-up is an explode of the path before an ordinary aggregation. No operator here walks the tree node by node.

prepared() adds to each node its nested-set interval, for filters that reach a scan, and its code: one character for each node of the path, which says the how-manieth child
it is. Codes are short strings where paths are arrays of ids, a clade is a prefix, the common ancestor is the common prefix, and their order in bytes is the tree's preorder.

Cases: a node whose parent is itself or null is a root; a node whose parent is not in the table starts a path of its own; ids that
are not in the table match nothing; repeated node rows count once; a cycle of parents is an error; an empty table has no paths.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..shared import drop_saved, saved

#: Ids with a meaning of their own: reads without a taxon, the tree's root, and reads that filters took out of a table.
UNCLASSIFIED, ROOT, FILTERED = 0, 1, 100_000_000
#: Ranks that canonical tables keep, top first; a parameter wherever it is used.
CANONICAL_RANKS = ("superkingdom", "phylum", "class", "order", "family", "genus", "species")
#: Ranks that a taxonomy may have at its top, in the place of the first canonical one or beside it.
TOP_RANKS = ("domain", "superkingdom")
#: Paths double in length each round, so this allows a depth of 2^16.
_ROUNDS = 16


def _levels(nodes: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Repeated rows of nodes counted once, with _parent (null for roots and where the parent isn't in the table); those that have children (t_id, _parent, rank, _children), and of them those
    that have grandchildren (t_id, path, ranks).

    Only the last have their paths walked. Each round joins what is known of a node's path to the path of its topmost node; the number of rounds is the logarithm of the depth.
    """
    # Rows meet before repeated ones are left out: names are sorted once.
    rows = nodes.select("t_id", "parent_id", "rank", "name").filter("t_id IS NOT NULL").repartition("t_id").dropDuplicates(["t_id"])
    nodes = saved(rows, "nodes").withColumn("_parent", F.when(F.col("parent_id") != F.col("t_id"), F.col("parent_id")))
    children = saved(_children(nodes), "children")
    inner = saved(nodes.select("t_id", "_parent", "rank").join(children, "t_id"), "inner")
    gone = children.join(inner, "t_id", "left_anti").select(F.col("t_id").alias("_parent"), F.lit(True).alias("_gone"))
    if gone.limit(1).count():
        rooted = lambda df: df.join(gone, "_parent", "left").withColumn("_parent", F.when(F.col("_gone").isNull(), F.col("_parent"))).drop("_gone")
        nodes, inner = rooted(nodes), saved(rooted(inner), "inner")
    known = inner.select("t_id", F.col("_parent").alias("top"), F.array(F.struct(F.col("t_id").alias("id"), "rank")).alias("up"))
    known = saved(known.join(inner.select(F.col("_parent").alias("t_id")).distinct(), "t_id", "left_semi"), "paths")
    for _ in range(_ROUNDS):
        if not known.filter("top IS NOT NULL").limit(1).count():
            break
        above = known.select(F.col("t_id").alias("top"), F.col("top").alias("next"), F.col("up").alias("more"))
        longer = known.join(above, "top", "left").select("t_id", F.col("next").alias("top"), F.when(F.col("more").isNull(), F.col("up")).otherwise(F.concat("up", "more")).alias("up"))
        before, known = known, saved(longer, "paths")
        drop_saved(before)
    else:
        raise ValueError("the parents of the taxonomy form a cycle")
    return nodes, inner, known.select("t_id", F.reverse("up.id").alias("path"), F.reverse("up.rank").alias("ranks"))


def _children(nodes: DataFrame) -> DataFrame:
    return nodes.filter("_parent IS NOT NULL").groupBy(F.col("_parent").alias("t_id")).agg(F.count(F.lit(1)).alias("_children"))


def _own(above: str, column: str, df: DataFrame) -> Column:
    """What is above a node, null for a root, and the node's own."""
    return F.concat(F.coalesce(F.col(above), F.array().cast(f"array<{df.schema[column].dataType.simpleString()}>")), F.array(column))


def with_paths(nodes: DataFrame) -> DataFrame:
    """nodes (t_id, parent_id, rank, name) with path and ranks (arrays from the root to the node itself) and depth (0 for a root).

    Paths are found for nodes that have grandchildren, a small part of most taxonomies; nodes with children, and then all, add themselves to their parent's.
    """
    nodes, inner, deep = _levels(nodes)
    deep = deep.select(F.col("t_id").alias("_parent"), F.col("path").alias("_path"), F.col("ranks").alias("_ranks"))
    above = inner.join(deep, "_parent", "left").select(F.col("t_id").alias("_parent"), _own("_path", "t_id", inner).alias("_path"), _own("_ranks", "rank", inner).alias("_ranks"))
    return _described(nodes.join(above, "_parent", "left"))


def _described(paths: DataFrame, *more: Column | str) -> DataFrame:
    depth = F.coalesce(F.size("_path"), F.lit(0)).alias("depth")
    return paths.select("t_id", "parent_id", "rank", "name", depth, _own("_path", "t_id", paths).alias("path"), _own("_ranks", "rank", paths).alias("ranks"), *more)


def canonical_ranks(taxa: DataFrame) -> tuple[str, ...]:
    """CANONICAL_RANKS with the top ranks that the taxonomy has."""
    found = {r["rank"] for r in taxa.filter(F.col("rank").isin(*TOP_RANKS)).select("rank").distinct().collect()}  # two rows at most
    return (*[r for r in TOP_RANKS if r in found or (not found and r in CANONICAL_RANKS)], *CANONICAL_RANKS[1:])


def closure(taxa: DataFrame) -> DataFrame:
    """(t_id, ancestor_id, ancestor_depth, ancestor_rank) of every node and ancestor-or-self."""
    return taxa.select("t_id", F.posexplode(F.arrays_zip("path", "ranks")).alias("ancestor_depth", "a")).select("t_id", F.col("a.path").alias("ancestor_id"), "ancestor_depth", F.col("a.ranks").alias("ancestor_rank"))


#: Children of a node that one character counts; each further ESCAPE before it adds as many. Surrogates are no characters.
_CHILDREN, _FIRST_SURROGATE, _SURROGATES = 1_000_000, 0xD800, 0x800
ESCAPE = chr(0x10FFFF)


def child_code(place: Column) -> Column:
    """The characters of a node that is its parent's child number place, from 0; in the order of places."""
    n = F.pmod(place, F.lit(_CHILDREN)) + 1
    point = F.when(n < _FIRST_SURROGATE, n).otherwise(n + _SURROGATES)
    return F.concat(F.repeat(F.lit(ESCAPE), F.floor(place / _CHILDREN).cast("int")), F.decode(F.unhex(F.lpad(F.hex(point), 8, "0")), "UTF-32"))


def child_places(code: Column) -> Column:
    """The places that a code was made of."""
    n = lambda c: F.ascii(F.right(c, F.lit(1))).cast("long")
    place = lambda c: (F.length(c) - 1) * _CHILDREN + F.when(n(c) < _FIRST_SURROGATE, n(c)).otherwise(n(c) - _SURROGATES) - 1
    return F.transform(F.regexp_extract_all(code, F.lit(f"{ESCAPE}*[^{ESCAPE}]"), F.lit(0)), place)


def code_depth(code: Column) -> Column:
    """Depth of the node with this code, 0 for a root; -1 for an empty one."""
    return F.length(F.translate(code, ESCAPE, "")) - 1


def common_code(a: Column, b: Column) -> Column:
    """Code of the lowest common ancestor; empty for nodes of different trees, null if either is unknown."""
    same = F.regexp_extract(F.concat(a, F.lit("\0"), b), "^([^\0]*)[^\0]*\0\\1", 1)
    return F.regexp_replace(same, f"{ESCAPE}+$", "")  # half a node


def _places(nodes: DataFrame, inner: DataFrame, deep: DataFrame) -> tuple[DataFrame, DataFrame]:
    """nodes (t_id, _parent, ...) with n (the nodes of its clade), step and at; and inner ones (_parent, _entry, _code) for their children to be joined to, with the other columns of deep.

    inner: nodes that have children (t_id, _parent, _children); deep: those that have grandchildren (t_id, path, ...), which alone have their paths walked. A node's entry is
    the sum along its path of one and of the sizes of the siblings before it, so no task sorts the whole tree. Sizes are sums of numbers of children; a node with
    children has a second row among its siblings for what its clade holds more than itself, so nodes need not be joined to their sizes.
    """
    below = inner.groupBy(F.col("_parent").alias("t_id")).agg(F.sum("_children").alias("_below"))
    below = deep.select("t_id", "path").join(below, "t_id").select(F.explode("path").alias("t_id"), "_below").groupBy("t_id").agg(F.sum("_below").alias("_below"))
    more = inner.join(below, "t_id", "left").select("t_id", "_parent", (F.col("_children") + F.coalesce("_below", F.lit(0))).alias("_n"), F.lit(1).alias("_second"))
    rows = nodes.withColumns({"_n": F.lit(1).cast("long"), "_second": F.lit(0)}).unionByName(more, allowMissingColumns=True)
    order = Window.partitionBy("_parent").orderBy("t_id", "_second")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    so_far = lambda c: F.coalesce(F.sum(c).over(earlier), F.lit(0))
    step = so_far(F.col("_n")) + F.when(F.col("_parent").isNull(), 0).otherwise(1)
    rows = rows.withColumns({"step": step, "_place": so_far(1 - F.col("_second")), "_more": F.when(F.lead("_second").over(order) == 1, F.lead("_n").over(order))}).filter("_second = 0")
    # One number a node, in the order of siblings; parents are looked up in it.
    steps = saved(rows.select(*nodes.columns, (1 + F.coalesce("_more", F.lit(0))).alias("n"), "step", child_code(F.col("_place")).alias("at")), "siblings")
    marked = steps.filter("n > 1")
    links = deep.select(F.col("t_id").alias("_deep"), F.posexplode("path").alias("_depth", "t_id"))
    # As long as the tree is deep.
    code = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_depth", "at"))), lambda x: x["at"]), "")
    made = links.join(marked.select("t_id", "step", "at"), "t_id").groupBy(F.col("_deep").alias("t_id")).agg(F.sum("step").alias("_entry"), code.alias("_code"))
    made = made.join(deep.withColumnsRenamed({c: f"_{c}" for c in deep.columns if c != "t_id"}), "t_id").withColumnRenamed("t_id", "_parent")
    return steps, marked.join(made, "_parent", "left").withColumns({"_entry": _entry(), "_code": _code()}).drop("_parent", "n", "step", "at").withColumnRenamed("t_id", "_parent")


def _entry() -> Column:
    return F.coalesce("_entry", F.lit(0)) + F.col("step")


def _code() -> Column:
    return F.concat(F.coalesce("_code", F.lit("")), "at")


def _intervals() -> list[Column]:
    return [_entry().alias("entry"), _code().alias("code"), (_entry() + F.col("n")).alias("exit")]


def nested_sets(taxa: DataFrame) -> DataFrame:
    """(t_id, depth, rank, entry, exit): preorder places; a clade is the half-open interval [entry, exit). A prepared taxonomy has them."""
    return coded(taxa).select("t_id", "depth", "rank", "entry", "exit")


def with_codes(taxa: DataFrame) -> DataFrame:
    """taxa (with paths) with entry, exit (see nested_sets()) and code."""
    narrow = taxa.select("t_id", F.try_element_at("path", F.lit(-2)).alias("_parent"))
    inner = saved(narrow.join(_children(narrow), "t_id"), "inner")
    deep = saved(taxa.select("t_id", "path").join(inner.select(F.col("_parent").alias("t_id")).distinct(), "t_id", "left_semi"), "paths")
    steps, above = _places(narrow, inner, deep)
    return taxa.join(steps.join(above.drop("_path"), "_parent", "left").select("t_id", *_intervals()), "t_id").select(*taxa.columns, "entry", "code", "exit")


def prepared(nodes: DataFrame) -> DataFrame:
    """Paths, intervals and codes of nodes (t_id, parent_id, rank, name).

    All nodes move to drop repeated ones, to find those that have children, to their siblings, and to their parent's path, interval and code; wide rows are only written.
    """
    nodes, inner, deep = _levels(nodes)
    steps, above = _places(nodes, inner.drop("rank"), deep)
    above = above.select("_parent", "_entry", "_code", _own("_path", "_parent", above).alias("_path"), _own("_ranks", "rank", above).alias("_ranks"))
    return _described(steps.join(above, "_parent", "left"), *_intervals())


def coded(taxa: DataFrame) -> DataFrame:
    """taxa itself if it is prepared."""
    return taxa if "code" in taxa.columns else with_codes(taxa)


def signature(taxa: DataFrame) -> str:
    """Names the intervals of a prepared taxonomy, so that tables which hold entries are used with no other."""
    r = taxa.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.bit_xor(F.xxhash64("t_id", "entry", "exit")), F.lit(0)).alias("h")).first()
    return f"{r['n']}-{r['h'] & (2**64 - 1):016x}"


def clade_ranges(taxa: DataFrame, wanted: list[int]) -> list[tuple[int, int, int]]:
    """(id, entry, exit) of the wanted ids that a prepared taxonomy has; wanted is a list that a user writes."""
    ids = [int(x) for x in dict.fromkeys(wanted)]
    return sorted((r["t_id"], r["entry"], r["exit"]) for r in taxa.filter(F.col("t_id").isin(*ids)).select("t_id", "entry", "exit").collect()) if ids else []


def is_within(code: Column, ancestor: Column) -> Column:
    """Whether the node with this code is the one with the other code or lies below it; false if either is unknown."""
    return F.coalesce(F.startswith(code, ancestor), F.lit(False))


def lowest_common(pairs: DataFrame, taxa: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """pairs with lca_id, lca_depth and distance (steps up and down between the two nodes).

    Codes go with the pairs, not paths; the common code is looked up among the taxa, so only nodes that are a common ancestor are read twice.
    """
    taxa = coded(taxa)
    side = lambda x, p: taxa.select(F.col("t_id").alias(x), F.col("code").alias(p))
    both = pairs.join(side(a, "_code_a"), a, "left").join(side(b, "_code_b"), b, "left").withColumn("_lca", common_code(F.col("_code_a"), F.col("_code_b")))
    lca = taxa.select(F.col("code").alias("_lca"), F.col("t_id").alias("lca_id"))
    d = code_depth(F.col("_lca"))
    steps = code_depth(F.col("_code_a")) + code_depth(F.col("_code_b")) - 2 * d
    return both.join(lca, "_lca", "left").select(*pairs.columns, "lca_id", d.alias("lca_depth"), steps.alias("distance"))


def clade_members(taxa: DataFrame, wanted: list[int]) -> DataFrame:
    """(target, t_id): every node of the clades of the wanted ids; a node of several of them comes once for each."""
    return taxa.select(F.explode(F.array_intersect("path", F.array(*[F.lit(int(x)).cast("long") for x in dict.fromkeys(wanted)]))).alias("target"), "t_id") if wanted else taxa.select(F.col("t_id").alias("target"), "t_id").limit(0)


def at_rank(taxa: DataFrame, rank: str, column: str) -> DataFrame:
    """(t_id, column): the first ancestor-or-self of a rank, for nodes that have one."""
    pairs = F.filter(F.arrays_zip("path", "ranks"), lambda x: x["ranks"] == rank)
    return taxa.select("t_id", F.try_element_at(pairs, F.lit(-1))["path"].alias(column)).filter(F.col(column).isNotNull())


def described(ids: DataFrame, taxa: DataFrame, ranks: tuple[str, ...] = CANONICAL_RANKS, strict: bool = False) -> DataFrame:
    """ids (t_id) with t_scientific_name, t_rank and a column t_<rank> for every rank: the name of the ancestor-or-self there.

    With strict, ids without a node are an error.
    """
    wanted = ids.select("t_id").distinct()
    if strict:
        unknown = [r["t_id"] for r in wanted.join(taxa, "t_id", "left_anti").limit(10).collect()]
        if unknown:
            raise ValueError(f"not in the taxonomy: {unknown}")
    names = taxa.select(F.col("t_id").alias("ancestor_id"), "name")
    up = closure(taxa.join(wanted, "t_id", "left_semi")).filter(F.col("ancestor_rank").isin(*ranks)).join(names, "ancestor_id")
    lineage = up.groupBy("t_id").pivot("ancestor_rank", list(ranks)).agg(F.max_by("name", "ancestor_depth"))
    for r in ranks:
        lineage = lineage.withColumnRenamed(r, f"t_{r}")
    own = wanted.join(taxa.select("t_id", F.col("name").alias("t_scientific_name"), F.col("rank").alias("t_rank")), "t_id", "left")
    return own.join(lineage, "t_id", "left")
