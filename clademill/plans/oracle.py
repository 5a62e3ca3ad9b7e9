"""DuckDB SQL for the queries of queries.py, over the same tables."""

from __future__ import annotations

from ..operators.features import RATIOS, ratio_names
from ..functions.stats import STATISTICS
from .queries import CLADE, MIN_OBSERVED, MIN_READS

#: Taxonomy, ancestors (anc at depth d, rank r), reads, hits and reports, as warehouse.py makes them.
_BASE = """
seg AS (SELECT c_mktsegment, row_number() OVER (ORDER BY c_mktsegment) - 1 AS s FROM (SELECT DISTINCT c_mktsegment FROM customer)),
cust AS (SELECT c_custkey, c_name, c_nationkey, c_mktsegment, s FROM customer JOIN seg USING (c_mktsegment)),
ord AS (SELECT o_orderkey, o_orderdate, c_custkey, c_nationkey, s, CAST(left(o_orderpriority, 1) AS BIGINT) AS p FROM orders JOIN cust ON o_custkey = c_custkey),
nodes AS (
  SELECT 1::BIGINT AS t_id, 1::BIGINT AS parent_id, 'no rank' AS rank, 'root' AS name
  UNION ALL SELECT 10 + r_regionkey, 1, 'superkingdom', r_name FROM region
  UNION ALL SELECT 100 + n_nationkey, 10 + n_regionkey, 'phylum', n_name FROM nation
  UNION ALL SELECT DISTINCT 1000 + 10 * c_nationkey + s, 100 + c_nationkey, 'clade', c_mktsegment || ' ' || c_nationkey FROM cust
  UNION ALL SELECT 100000 + c_custkey, 1000 + 10 * c_nationkey + s, 'species', c_name FROM cust
  UNION ALL SELECT DISTINCT 10000000 + 10 * c_custkey + p, 100000 + c_custkey, 'strain', 'strain ' || (10000000 + 10 * c_custkey + p) FROM ord),
up AS (
  SELECT t_id, t_id AS anc, 0 AS k FROM nodes
  UNION ALL SELECT up.t_id, n.parent_id, k + 1 FROM up JOIN nodes n ON n.t_id = up.anc WHERE n.parent_id <> n.t_id),
clo AS (SELECT up.t_id, anc, (max(k) OVER (PARTITION BY up.t_id) - k)::INT AS d, n.rank AS r, n.name AS n FROM up JOIN nodes n ON n.t_id = anc),
dep AS (SELECT t_id, max(d) AS depth FROM clo GROUP BY t_id),
reads AS (
  SELECT o_orderkey AS read_id, strftime(o_orderdate, '%Y-%m') AS sample_id, isoyear(o_orderdate)::INT AS year, week(o_orderdate)::INT AS week,
         CASE WHEN o_orderkey % 10 = 0 THEN 'U' ELSE 'C' END AS status,
         (CASE WHEN o_orderkey % 10 = 0 THEN 0 WHEN o_orderkey % 10 = 1 THEN 100 + c_nationkey WHEN o_orderkey % 10 = 2 THEN 1000 + 10 * c_nationkey + s
               WHEN o_orderkey % 10 <= 7 THEN 100000 + c_custkey ELSE 10000000 + 10 * c_custkey + p END)::BIGINT AS t_id,
         (50 + o_orderkey % 100)::INT AS r1_len, (50 + 7 * o_orderkey % 100)::INT AS r2_len
  FROM ord),
hits AS (
  SELECT l_orderkey AS read_id, l_partkey, l_quantity::BIGINT AS q,
         (CASE l_linenumber % 4 WHEN 0 THEN 0 WHEN 1 THEN 100000 + c_custkey WHEN 2 THEN 100 + s_nationkey ELSE 100 + c_nationkey END)::BIGINT AS hit
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN ord ON l_orderkey = o_orderkey),
counts AS (SELECT sample_id, t_id, count(*) AS taxon_reads FROM reads GROUP BY ALL),
sp AS (SELECT t_id, anc AS species_id FROM clo WHERE r = 'species'),
"""

_KMERS = """
kmers AS (
  SELECT sample_id, species_id AS t_id, hit AS kmer_tax_id, coalesce(sum(q), 0)::BIGINT AS kmer_count
  FROM reads JOIN sp USING (t_id) LEFT JOIN hits USING (read_id) WHERE status = 'C' GROUP BY ALL),
"""

_LENGTHS = """
lengths AS (SELECT sample_id, species_id AS t_id, (r1_len + r2_len)::INT AS read_length, count(*) AS read_count FROM reads JOIN sp USING (t_id) WHERE status = 'C' GROUP BY ALL),
"""


def _clades(src: str, name: str = "clades", clo: str = "clo") -> str:
    """Clade sums of src (t_id, sample_id, taxon_reads); ids without ancestors are their own."""
    return f"""
{name}_up AS (SELECT c.t_id AS own, c.sample_id, c.taxon_reads, coalesce(a.anc, c.t_id) AS t_id, coalesce(a.d, 0) AS d, a.anc IS NOT NULL AS known FROM {src} c LEFT JOIN {clo} a ON a.t_id = c.t_id),
{name} AS (
  SELECT t_id, sample_id, sum(CASE WHEN own = t_id THEN taxon_reads ELSE 0 END)::BIGINT AS taxon_reads, sum(taxon_reads)::BIGINT AS clade_reads, bool_or(known) AS known
  FROM {name}_up GROUP BY t_id, sample_id),
"""


def _pushed(src: str, top: int = 1, clo: str = "clo", name: str = "pushed") -> str:
    """Level by level it would be a loop; the nearest passing ancestor is looked up for every taxon instead."""
    return f"""
{_clades(src, "cs", clo)}
passing AS (SELECT t_id FROM cs GROUP BY t_id HAVING NOT bool_or(known) OR t_id = {top} OR (max(clade_reads) >= {MIN_READS} AND count(*) FILTER (WHERE clade_reads > 0) >= {MIN_OBSERVED})),
goal AS (SELECT DISTINCT own, arg_max(t_id, d) OVER (PARTITION BY own) AS t_id FROM cs_up JOIN passing USING (t_id)),
landed AS (SELECT g.t_id, sample_id, sum(taxon_reads)::BIGINT AS taxon_reads FROM {src} c JOIN goal g ON g.own = c.t_id GROUP BY ALL),
{name} AS (
  SELECT cs.t_id, cs.sample_id, coalesce(l.taxon_reads, 0)::BIGINT AS taxon_reads, cs.clade_reads
  FROM cs JOIN passing USING (t_id) LEFT JOIN landed l ON l.t_id = cs.t_id AND l.sample_id = cs.sample_id
  UNION ALL
  SELECT 0, sample_id, 0, 0 FROM (SELECT DISTINCT sample_id FROM {src}) WHERE sample_id NOT IN (SELECT sample_id FROM {src} WHERE t_id = 0) AND EXISTS (SELECT 1 FROM {src} WHERE t_id = 0)),
"""


_BARE = f"classified AS (SELECT * FROM counts WHERE t_id <> 0), in_clade AS (SELECT t_id FROM clo WHERE anc = {CLADE}),"
#: The clade's reads alone, with and without those of no taxon, and its part of the closure.
_PART = f"""
{_BARE}
part AS (SELECT * FROM counts WHERE t_id IN (FROM in_clade) OR t_id = 0),
part_c AS (SELECT * FROM counts WHERE t_id IN (FROM in_clade)),
clo_c AS (SELECT c.t_id, c.anc, c.d - t.d AS d, c.r, c.n FROM clo c JOIN clo t ON t.t_id = c.t_id AND t.anc = {CLADE} WHERE c.d >= t.d),
"""
_ALL = "totals_all AS (SELECT sample_id, sum(taxon_reads)::BIGINT AS n FROM counts GROUP BY 1),"


def _canonical(src: str, clo: str = "clo", top: int = 1, limits: bool = True) -> str:
    """Remainders at root, superkingdom, phylum and species (the canonical ranks that occur), bubbled up from the deepest."""
    sql = f"""
route AS (SELECT t_id, max(anc) FILTER (WHERE r = 'superkingdom' AND anc <> {top}) AS k, max(anc) FILTER (WHERE r = 'phylum' AND anc <> {top}) AS ph, max(anc) FILTER (WHERE r = 'species') AS s FROM {clo} GROUP BY t_id),
b3 AS (SELECT coalesce(s, ph, k, {top}) AS node, CASE WHEN s IS NOT NULL THEN coalesce(ph, k, {top}) END AS p3, CASE WHEN s IS NULL AND ph IS NOT NULL THEN coalesce(k, {top}) END AS p2, k, ph, s, sample_id, sum(taxon_reads)::BIGINT AS v
       FROM {src} JOIN route USING (t_id) GROUP BY ALL),
"""
    before = "b3"
    low, seen = (MIN_READS, MIN_OBSERVED) if limits else (0, 0)
    # Species go to their phylum, phyla to their superkingdom, superkingdoms to the root.
    for level, up in (("s", f"coalesce(ph, k, {top})"), ("ph", f"coalesce(k, {top})"), ("k", f"{top}")):
        deeper = {"s": [], "ph": ["s"], "k": ["s", "ph"]}[level]
        is_level = " AND ".join([f"{level} IS NOT NULL", *[f"{x} IS NULL" for x in deeper]])
        sql += f"""
f_{level} AS (SELECT node FROM {before} WHERE {is_level} GROUP BY node HAVING max(v) < {low} OR count(*) FILTER (WHERE v > 0) < {seen}),
a_{level} AS (
  SELECT CASE WHEN f.node IS NOT NULL THEN {up} ELSE b.node END AS node, b.k AS k0, b.ph AS ph0, b.s AS s0, f.node IS NOT NULL AS gone, sample_id, v FROM {before} b LEFT JOIN f_{level} f ON f.node = b.node),
b_{level} AS (
  SELECT node, {", ".join(f"CASE WHEN gone THEN {'NULL' if x == level else x + '0'} ELSE {x}0 END AS {x}" for x in ("k", "ph", "s"))}, sample_id, sum(v)::BIGINT AS v FROM a_{level} GROUP BY ALL),
"""
        before = f"b_{level}"
    return sql + f"canonical AS (SELECT node::BIGINT AS t_id, sample_id, v AS value FROM {before} WHERE v > 0),"


def _q(body: str, *ctes: str) -> str:
    joined = "".join(ctes).rstrip().rstrip(",")
    return f"WITH RECURSIVE {(_BASE + joined).rstrip().rstrip(',')}\n{body}"


def _filtered_row(cells: str, mode: str) -> str:
    """cells with what the clade leaves out."""
    held = "sum(value)" if mode != "clade" else "coalesce(max(value) FILTER (WHERE t_id <> 0), 0) + coalesce(sum(value) FILTER (WHERE t_id = 0), 0)"
    return f"""
held AS (SELECT sample_id, {held} AS h FROM {cells} GROUP BY 1),
full_cells AS (SELECT * FROM {cells} UNION ALL SELECT 100000000, sample_id, greatest(n - h, 0)::BIGINT FROM held JOIN totals_all USING (sample_id) WHERE n > h),
"""


def _weighted(src: str, keys: str, value: str, weight: str, name: str) -> str:
    """Weighted mean, median, stdev, cv, p05 and p95 as a CTE."""
    return f"""
{name}_c AS (SELECT {keys}, ({value})::DOUBLE AS x, sum({weight})::DOUBLE AS w FROM {src} WHERE ({value}) IS NOT NULL AND {weight} > 0 GROUP BY ALL),
{name}_p AS (SELECT *, sum(w) OVER (PARTITION BY {keys}) AS n, sum(x * w) OVER (PARTITION BY {keys}) AS sx, sum(w) OVER (PARTITION BY {keys} ORDER BY x ROWS UNBOUNDED PRECEDING) AS cw FROM {name}_c),
{name}_s AS (
  SELECT {keys}, max(sx / n) AS mean, min(x) FILTER (WHERE cw >= 0.5 * n) AS median, CASE WHEN max(n) > 1 THEN sqrt(sum(w * (x - sx / n) ^ 2) / (max(n) - 1)) END AS stdev,
         min(x) FILTER (WHERE cw >= 0.05 * n) AS p05, min(x) FILTER (WHERE cw >= 0.95 * n) AS p95 FROM {name}_p GROUP BY {keys}),
{name} AS (SELECT *, CASE WHEN mean <> 0 THEN stdev / mean END AS cv FROM {name}_s),
"""


def _nearest(v: str, q: float) -> str:
    """Value nearest to a quantile's place among those that are not null."""
    return f"list_sort(list({v}) FILTER (WHERE {v} IS NOT NULL))[round((count({v}) - 1) * {q})::INT + 1]"


def _plain(v: str, name: str) -> str:
    """Six statistics of a column, in the order of STATISTICS."""
    sd = f"stddev_samp({v})"
    made = {"mean": f"avg({v})", "median": f"median({v})", "stdev": sd, "cv": f"CASE WHEN avg({v}) <> 0 THEN {sd} / avg({v}) END", "p05": _nearest(v, 0.05), "p95": _nearest(v, 0.95)}
    return ", ".join(f"round({made[s]}, 6) AS {name}_{s}" for s in STATISTICS)


def _labels(keys: str) -> str:
    """Hits of kmers by keys with their place in the tree."""
    return f"""
pooled AS (SELECT {keys}, kmer_tax_id, sum(kmer_count)::BIGINT AS c FROM kmers GROUP BY ALL),
pairs AS (SELECT DISTINCT t_id, kmer_tax_id FROM pooled),
lca AS (SELECT p.t_id, p.kmer_tax_id, max(a.d) AS l FROM pairs p JOIN clo a ON a.t_id = p.t_id JOIN clo b ON b.t_id = p.kmer_tax_id AND a.anc = b.anc GROUP BY ALL),
lab AS (
  SELECT o.*, coalesce(o.kmer_tax_id IN (SELECT t_id FROM clo WHERE anc = o.t_id), false) AS in_clade,
         coalesce(o.kmer_tax_id IN (SELECT anc FROM clo WHERE t_id = o.t_id), false) AS in_line, td.depth AS td, kd.depth AS kd, lca.l
  FROM pooled o LEFT JOIN dep td ON td.t_id = o.t_id LEFT JOIN dep kd ON kd.t_id = o.kmer_tax_id LEFT JOIN lca ON lca.t_id = o.t_id AND lca.kmer_tax_id = o.kmer_tax_id),
""".replace("coalesce(o.kmer_tax_id IN (SELECT t_id FROM clo WHERE anc = o.t_id), false)", "coalesce(lca.l = td.depth, false)").replace("coalesce(o.kmer_tax_id IN (SELECT anc FROM clo WHERE t_id = o.t_id), false)", "coalesce(lca.l = kd.depth, false)")


def _ratio_ctes(keys: str) -> str:
    return _labels(keys) + f"""
n0 AS (
  SELECT {keys}, sum(c)::BIGINT AS total, coalesce(sum(c) FILTER (WHERE in_clade), 0)::BIGINT AS clade, coalesce(sum(c) FILTER (WHERE NOT in_clade AND kmer_tax_id > 0), 0)::BIGINT AS exclade,
         coalesce(sum(c) FILTER (WHERE in_line AND NOT in_clade), 0)::BIGINT AS lineage, coalesce(sum(c) FILTER (WHERE kmer_tax_id = 1 AND NOT in_clade), 0)::BIGINT AS root FROM lab GROUP BY {keys}),
n AS (SELECT *, clade + exclade AS classified, exclade - lineage AS misclassified, total - clade - exclade AS unclassified, clade + lineage AS supporting FROM n0),
"""


def _kmer_sql(scope: str) -> dict[str, str]:
    keys, k, p = ("t_id", 5, "kmers_global") if scope == "global" else ("sample_id, t_id", 3, "kmers_sample")
    counts = ("total", "classified", "unclassified", "clade", "exclade", "lineage", "root", "misclassified")
    ratios = ", ".join(f"round(CASE WHEN {b} > 0 THEN {a} / {b} END, 6) AS {name}" for (a, b), name in zip(RATIOS, ratio_names(p), strict=True))
    base = _KMERS + _ratio_ctes(keys)
    metrics = {
        "misclassified_dist": "CASE WHEN NOT in_line THEN td + kd - 2 * l END", "misclassified_depth": "CASE WHEN NOT in_line THEN kd END",
        "misclassified_relative_lca_depth": "CASE WHEN NOT in_line AND td > 1 THEN l / (td - 1) END", "lineage_relative_depth": "CASE WHEN in_line AND td > 1 THEN kd / (td - 1) END",
    }
    stats = "out_hits AS (SELECT * FROM lab WHERE NOT in_clade AND kmer_tax_id > 0)," + "".join(_weighted("out_hits", keys, v, "c", f"w{i}") for i, v in enumerate(metrics.values()))
    wanted = ", ".join(f"round(w{i}.{s}, 6) AS {p}_{m}_{s}" for i, m in enumerate(metrics) for s in STATISTICS)
    joins = " ".join(f"LEFT JOIN w{i} USING ({keys})" for i in range(len(metrics)))
    own = ", ".join(f"n.{x.strip()}" for x in keys.split(","))
    top = ""
    for kind, cond in (("misclassified", "NOT in_line"), ("exclade", "true")):
        top += f"""
r_{kind} AS (SELECT lab.*, nodes.name, row_number() OVER (PARTITION BY {", ".join("lab." + x.strip() for x in keys.split(","))} ORDER BY c DESC, kmer_tax_id) AS rk, c / sum(c) OVER (PARTITION BY {", ".join("lab." + x.strip() for x in keys.split(","))}) AS share
        FROM lab LEFT JOIN nodes ON nodes.t_id = kmer_tax_id WHERE NOT in_clade AND kmer_tax_id > 0 AND {cond}),
t_{kind} AS (SELECT {keys}, string_agg(kmer_tax_id::VARCHAR, ';' ORDER BY rk) AS {p}_{kind}_top{k}_taxids, string_agg(format('{{:.4f}}', share), ';' ORDER BY rk) AS {p}_{kind}_top{k}_shares,
        string_agg(coalesce(name, 'Unknown'), ';' ORDER BY rk) AS {p}_{kind}_top{k}_names FROM r_{kind} WHERE rk <= {k} GROUP BY {keys}),
"""
    return {
        f"kmer_{scope}_counts": _q(f"SELECT {keys}, {', '.join(f'{c} AS {p}_{c}_count' for c in counts)} FROM n", base),
        f"kmer_{scope}_ratios": _q(f"SELECT {keys}, {ratios} FROM n", base),
        f"kmer_{scope}_stats": _q(f"SELECT {own}, {wanted} FROM n {joins}", base, stats),
        f"kmer_{scope}_top": _q(f"SELECT n.* EXCLUDE (total, clade, exclade, lineage, root, classified, misclassified, unclassified, supporting), t_misclassified.* EXCLUDE ({keys}), t_exclade.* EXCLUDE ({keys}) FROM n LEFT JOIN t_misclassified USING ({keys}) LEFT JOIN t_exclade USING ({keys})", base, top),
    }


_YEARLY = "yearly AS (SELECT t_id, left(sample_id, 4) AS sample_id, sum(taxon_reads)::BIGINT AS taxon_reads FROM counts GROUP BY ALL),"
#: The years of the orders in all given tables.
_YEARS = [str(y) for y in range(1995, 2002)]
#: Their months, up to August of the last year.
_MONTHS = [f"{y}-{m:02}" for y in range(1995, 2002) for m in range(1, 13) if (y, m) <= (2001, 8)]


def _wide(samples: list[str]) -> str:
    """pushed as a table with a column a sample."""
    return "wide AS (SELECT t_id, " + ", ".join(f"coalesce(sum(clade_reads) FILTER (WHERE sample_id = '{s}'), 0)::BIGINT AS \"{s}\"" for s in samples) + " FROM pushed GROUP BY t_id),"


def _long(samples: list[str]) -> str:
    return "long AS (" + " UNION ALL ".join(f"SELECT t_id, '{s}' AS sample_id, \"{s}\"::DOUBLE AS value FROM wide" for s in samples) + "),"


_WIDE = _YEARLY + _pushed("yearly") + _wide(_YEARS)
_LONG = _long(_YEARS)
_MONTHLY = _pushed("counts") + _wide(_MONTHS)
_LINEAGE = """
lin AS (SELECT t_id, max(n) FILTER (WHERE r = 'superkingdom') AS t_superkingdom, max(n) FILTER (WHERE r = 'phylum') AS t_phylum, max(n) FILTER (WHERE r = 'species') AS t_species FROM clo GROUP BY t_id),
"""

_MINIMIZERS = (
    _clades("counts") + """
seen AS (SELECT sample_id, t_id, sum(q)::BIGINT AS mm_tot, count(DISTINCT l_partkey) AS mm_uniq FROM reads JOIN (SELECT l_orderkey AS read_id, l_partkey, l_quantity::BIGINT AS q FROM lineitem) USING (read_id) GROUP BY ALL),
rep AS (SELECT c.t_id, c.sample_id, coalesce(mm_tot, 0) AS mm_tot, coalesce(mm_uniq, 0) AS mm_uniq FROM counts c LEFT JOIN seen s ON s.t_id = c.t_id AND s.sample_id = c.sample_id),
mm AS (
  SELECT c.t_id, c.sample_id, clade_reads AS reads_tot, mm_tot, mm_uniq, mm_uniq / clade_reads AS mm_uniq_per_read, CASE WHEN mm_tot > 0 THEN mm_uniq / mm_tot END AS mm_uniq_prop,
         CASE WHEN n.t_id IS NOT NULL THEN mm_uniq / (1000 + c.t_id % 9000) END AS mm_obs_cov, CASE WHEN n.t_id IS NOT NULL THEN (1000 + c.t_id % 9000)::DOUBLE END AS db
  FROM clades c LEFT JOIN rep USING (t_id, sample_id) LEFT JOIN nodes n ON n.t_id = c.t_id WHERE c.t_id <> 0),
mm2 AS (SELECT *, median(mm_uniq_per_read) OVER (PARTITION BY t_id) AS usual FROM mm),
mm3 AS (SELECT *, CASE WHEN usual > 0 THEN 1 - pow(1 - usual / db, reads_tot) END AS mm_exp_cov FROM mm2),
""")  # fmt: skip


def _p_value(r: str, n: str) -> str:
    """Two-tailed p by the finite series; coefficients are products."""
    v = f"({n} - 2)"
    theta = f"atan(abs({r}) * sqrt({v} / (1 - {r} * {r})) / sqrt({v}))"
    even = f"sin({theta}) * (1 + coalesce(list_sum(list_transform(range(1, ({v} // 2)::BIGINT), lambda k: list_product(list_transform(range(1, k + 1), lambda j: (2 * j - 1) / (2 * j))) * cos({theta}) ^ (2 * k))), 0))"
    odd = f"2 / pi() * ({theta} + CASE WHEN {v} > 1 THEN sin({theta}) * (cos({theta}) + coalesce(list_sum(list_transform(range(1, (({v} - 1) // 2)::BIGINT), lambda k: list_product(list_transform(range(1, k + 1), lambda j: (2 * j) / (2 * j + 1))) * cos({theta}) ^ (2 * k + 1))), 0)) ELSE 0 END)"
    return f"CASE WHEN {n} >= 3 AND {r} IS NOT NULL THEN CASE WHEN abs({r}) >= 1 THEN 0.0 ELSE greatest(1 - CASE WHEN {v} % 2 = 1 THEN {odd} ELSE {even} END, 0.0) END END"


def oracle_sql() -> dict[str, str]:
    cells = lambda c: f"SELECT t_id, sample_id, {c} AS value FROM pushed WHERE {c} > 0 OR t_id = 0"
    share = lambda src, clade: (
        f"SELECT t_id, sample_id, round(value / t, 6) AS value FROM ({src}) JOIN (SELECT sample_id, "
        + ("coalesce(max(value) FILTER (WHERE t_id <> 0), 0) + coalesce(sum(value) FILTER (WHERE t_id = 0), 0)" if clade else "sum(value)")
        + f" AS t FROM ({src}) GROUP BY 1) USING (sample_id)"
    )
    name = f"CASE WHEN len(string_split(n.name, ' ')) > 1 THEN concat(upper(n.name[1]), lower(n.name[2:3]), upper(string_split(n.name, ' ')[2][1]), lower(string_split(n.name, ' ')[2][2:3])) ELSE n.name END"
    readlen = lambda keys, least, p: (
        f"pl AS (SELECT {keys}, read_length, sum(read_count)::BIGINT AS read_count FROM lengths GROUP BY ALL)," + _weighted("pl", keys, "read_length", "read_count", "ws")
        + f"tot AS (SELECT {keys}, sum(read_count)::BIGINT AS {p}_total_count FROM pl GROUP BY ALL HAVING sum(read_count) >= {least}),"
    )
    readlen_cols = lambda p: ", ".join(f"round({s}, 6) AS {p}_readlen_{s}" for s in STATISTICS)
    sample_len = _q(f"SELECT t_id, sample_id, reads_sample_total_count, {readlen_cols('reads_sample')} FROM ws JOIN tot USING (t_id, sample_id)", _LENGTHS, readlen("t_id, sample_id", 0, "reads_sample"))
    stable = ", ".join(_plain(b, a) for a, b in zip(ratio_names("kmers_stability"), [f"(CASE WHEN {d} > 0 THEN {c} / {d} END)" for c, d in RATIOS], strict=True))
    kmer_rows = _q("SELECT sample_id, t_id, kmer_tax_id, kmer_count FROM kmers", _KMERS)
    weight = lambda col, agg: f"""
own_w AS (SELECT t_id, {col} AS w FROM wide WHERE t_id NOT IN (0, 100000000)),
cw AS (SELECT c.anc AS node, {agg}(w) AS cw FROM own_w JOIN clo c USING (t_id) GROUP BY 1),
place AS (SELECT node, row_number() OVER (PARTITION BY CASE WHEN parent_id <> t_id THEN parent_id END ORDER BY cw DESC, node) AS pl FROM cw JOIN nodes ON t_id = node),
"""  # noqa: E731
    dfs = "SELECT w.t_id, CASE w.t_id WHEN 0 THEN '0' WHEN 100000000 THEN '1' WHEN 1 THEN '2' ELSE (SELECT '3/' || string_agg(pl::VARCHAR, '/' ORDER BY c.d) FROM clo c JOIN place ON node = c.anc WHERE c.t_id = w.t_id) END AS dfs_key FROM wide w"
    mean = "(" + " + ".join(f'"{y}"' for y in _YEARS) + f")::DOUBLE / {len(_YEARS)}"
    median = "list_sort([" + ", ".join(f'"{y}"' for y in _YEARS) + f"])[{len(_YEARS) // 2 + 1}]::DOUBLE"
    corr = """
rk AS (SELECT * REPLACE (CASE WHEN mm_obs_cov IS NOT NULL THEN mm_exp_cov END AS mm_exp_cov), count(*) OVER (PARTITION BY t_id) AS n, row_number() OVER (PARTITION BY t_id ORDER BY mm_obs_cov DESC NULLS LAST, sample_id) AS place FROM mm3),
fl AS (SELECT *, place > round(greatest(n * 1 / 100, 3)) AND mm_obs_cov IS NOT NULL AS inside FROM rk),
co AS (
  SELECT t_id, max(n) AS n, count(*) FILTER (WHERE inside) AS nf,
         CASE WHEN max(n) >= 6 AND max(mm_obs_cov) - min(mm_obs_cov) > 1e-12 * max(mm_obs_cov) AND max(mm_exp_cov) - min(mm_exp_cov) > 1e-12 * max(mm_exp_cov) THEN corr(mm_obs_cov, mm_exp_cov) END AS r,
         CASE WHEN max(n) >= 6 AND max(mm_obs_cov) FILTER (WHERE inside) - min(mm_obs_cov) FILTER (WHERE inside) > 1e-12 * max(mm_obs_cov) FILTER (WHERE inside) AND max(mm_exp_cov) FILTER (WHERE inside) - min(mm_exp_cov) FILTER (WHERE inside) > 1e-12 * max(mm_exp_cov) FILTER (WHERE inside)
              THEN corr(mm_obs_cov, mm_exp_cov) FILTER (WHERE inside) END AS rf, PLAIN
  FROM fl GROUP BY t_id),
""".replace("PLAIN", _plain("mm_obs_cov", "mm_obs_cov"))  # noqa: E501
    # Own reads and taxa by rank: of clade sums before, of the table's cells after.
    audit = lambda mode: _q(
        "SELECT rank, coalesce(max(n) FILTER (WHERE k = 0), 0) AS taxa_before, coalesce(max(n) FILTER (WHERE k = 1), 0) AS taxa_after, coalesce(max(x) FILTER (WHERE k = 0), 0)::BIGINT AS reads_before, coalesce(max(x) FILTER (WHERE k = 1), 0)::BIGINT AS reads_after FROM ("
        "SELECT k, CASE WHEN t_id = 0 THEN 'unclassified' ELSE coalesce(n.rank, 'unknown') END AS rank, count(DISTINCT t_id) AS n, sum(x) AS x FROM ("
        "SELECT 0 AS k, t_id, taxon_reads AS x FROM clades UNION ALL "
        + {"taxon": "SELECT 1, t_id, taxon_reads FROM pushed WHERE taxon_reads > 0 OR t_id = 0", "clade": "SELECT 1, t_id, taxon_reads FROM pushed", "canonical": "SELECT 1, t_id, value FROM canonical UNION ALL SELECT 1, t_id, taxon_reads FROM counts WHERE t_id = 0"}[mode]
        + ") LEFT JOIN nodes n USING (t_id) GROUP BY ALL) GROUP BY rank",
        _clades("counts"), "classified AS (SELECT * FROM counts WHERE t_id <> 0)," + _canonical("classified") if mode == "canonical" else _pushed("counts"),
    )
    keep = lambda col, mode: _q("FROM full_cells", _PART, _pushed("part", CLADE, "clo_c"), _ALL, f"cells AS ({cells(col)}),", _filtered_row("cells", mode))
    return {
        "taxonomy_paths": _q("SELECT n.t_id, parent_id, rank, name, depth, path FROM nodes n JOIN dep USING (t_id) JOIN (SELECT t_id, string_agg(anc::VARCHAR, '/' ORDER BY d) AS path FROM clo GROUP BY 1) USING (t_id)"),
        "nested_sets": _q(
            "SELECT t_id, depth, n.rank, row_number() OVER (ORDER BY path) - 1 AS entry, row_number() OVER (ORDER BY path) - 1 + size AS exit FROM nodes n JOIN dep USING (t_id) JOIN (SELECT t_id, list(anc ORDER BY d) AS path FROM clo GROUP BY 1) USING (t_id) "
            "JOIN (SELECT anc AS t_id, count(*) AS size FROM clo GROUP BY 1) USING (t_id)"
        ),
        "taxonomy_closure": _q("SELECT t_id, anc AS ancestor_id, d AS ancestor_depth, r AS ancestor_rank FROM clo"),
        "clade_members": _q(f"SELECT anc AS target, t_id FROM clo WHERE anc IN ({CLADE}, 100, 1000)"),
        "lca_distance": _q(
            "SELECT t_id, kmer_tax_id, arg_max(anc, d) AS lca_id, max(d) AS lca_depth, (max(td) + max(kd) - 2 * max(d))::INT AS distance FROM (SELECT p.t_id, p.kmer_tax_id, a.anc, a.d, x.depth AS td, y.depth AS kd "
            "FROM (SELECT DISTINCT t_id, kmer_tax_id FROM kmers WHERE kmer_tax_id > 0) p JOIN clo a ON a.t_id = p.t_id JOIN clo b ON b.t_id = p.kmer_tax_id AND a.anc = b.anc JOIN dep x ON x.t_id = p.t_id JOIN dep y ON y.t_id = p.kmer_tax_id) GROUP BY t_id, kmer_tax_id", _KMERS,
        ),
        "annotate_lineage": _q("SELECT t_id, name AS t_scientific_name, rank AS t_rank, t_superkingdom, t_phylum, t_species FROM (SELECT DISTINCT t_id FROM reads WHERE t_id > 0) JOIN nodes USING (t_id) JOIN lin USING (t_id)", _LINEAGE),
        "report_merge": _q("FROM counts"),
        "report_files_read": _q("SELECT sample_id, t_id, taxon_reads, mm_tot, mm_uniq FROM rep JOIN counts USING (t_id, sample_id)", _MINIMIZERS),
        "period_counts": _q("SELECT t_id, year || '_' || lpad(week::VARCHAR, 2, '0') AS sample_id, count(*) AS taxon_reads FROM reads WHERE sample_id NOT IN ('1995-01', '2001-07') GROUP BY ALL"),
        "clade_sum": _q("SELECT t_id, sample_id, taxon_reads, clade_reads FROM clades", _clades("counts")),
        "clade_pushup": _q("FROM pushed", _pushed("counts")),
        "mass_balance": _q("SELECT sample_id, sum(taxon_reads)::BIGINT AS reads, sum(taxon_reads)::BIGINT AS pushed_up, sum(taxon_reads)::BIGINT AS bubbled FROM counts WHERE t_id <> 0 GROUP BY 1"),
        "rank_totals": _q("SELECT CASE WHEN c.t_id = 0 THEN 'unclassified' ELSE coalesce(n.rank, 'unknown') END AS rank, sum(clade_reads)::BIGINT AS total, count(DISTINCT c.t_id) AS n_taxa FROM clades c LEFT JOIN nodes n USING (t_id) GROUP BY 1", _clades("counts")),
        "taxon_table": _q(cells("taxon_reads"), _pushed("counts")),
        "clade_table": _q(cells("clade_reads"), _BARE, _pushed("classified")),
        "clade_filtered": _q(cells("clade_reads"), _PART, _pushed("part_c", CLADE, "clo_c")),
        "keep_filtered_taxon": keep("taxon_reads", "taxon"),
        "keep_filtered_clade": keep("clade_reads", "clade"),
        "proportions_taxon": _q(share(cells("taxon_reads"), False), _pushed("counts")),
        "proportions_clade": _q(share(cells("clade_reads"), True), _pushed("counts")),
        "canonical_remainder": _q("FROM canonical UNION ALL SELECT 0, sample_id, coalesce(sum(taxon_reads) FILTER (WHERE t_id = 0), 0)::BIGINT FROM counts GROUP BY sample_id", _canonical("counts", limits=False)),
        "canonical_bubbled": _q("FROM canonical", _BARE, _canonical("classified")),
        "canonical_clade": _q(
            "FROM full_cells", _PART, "totals_all AS (SELECT sample_id, sum(taxon_reads)::BIGINT AS n FROM classified GROUP BY 1),", _canonical("part_c", "clo_c", CLADE), _filtered_row("canonical", "taxon")
        ),
        "wide_table": _q("FROM wide", _WIDE),
        "wide_monthly": _q("FROM wide", _MONTHLY),
        "abundance_monthly": _q(f"SELECT t_id, {_plain('value', 'abund_global')} FROM long GROUP BY t_id", _MONTHLY, _long(_MONTHS)),
        "species_rollup": _q("SELECT read_id, t_id, species_id FROM reads JOIN sp USING (t_id)"),
        "kmer_aggregate": kmer_rows,
        "kmer_stream": _q("SELECT t_id, kmer_tax_id, sum(kmer_count)::BIGINT AS kmer_count FROM kmers GROUP BY ALL", _KMERS),
        "read_length_aggregate": _q("SELECT sample_id, t_id, read_length, read_count FROM lengths", _LENGTHS),
        **_kmer_sql("global"),
        **_kmer_sql("sample"),
        "kmer_stability": _q(f"SELECT t_id, round(count(*) / (SELECT count(DISTINCT sample_id) FROM n), 6) AS kmers_stability_occupancy_ratio, {stable} FROM n GROUP BY t_id", _KMERS, _ratio_ctes("sample_id, t_id")),
        "readlen_global": _q(f"SELECT t_id, reads_global_total_count, {readlen_cols('reads_global')} FROM ws JOIN tot USING (t_id)", _LENGTHS, readlen("t_id", 5, "reads_global")),
        "readlen_sample": sample_len,
        "chunk_union": sample_len,
        "abundance_stats": _q(f"SELECT t_id, {_plain('value', 'abund_global')} FROM long GROUP BY t_id", _WIDE, _LONG),
        "abundance_norm": _q(
            f"SELECT t_id, {_plain('value', 'abund_global')}, round(avg(value / db), 6) AS \"abund_global_meanVSmm_ratio\", round(median(value / db), 6) AS \"abund_global_medianVSmm_ratio\" "
            "FROM long LEFT JOIN (SELECT t_id, 1000 + t_id % 9000 AS db FROM nodes) USING (t_id) GROUP BY t_id", _WIDE, _LONG,
        ),
        "minimizer_cov": _q("SELECT t_id, sample_id, reads_tot, mm_tot, mm_uniq, round(mm_uniq_per_read, 6) AS mm_uniq_per_read, round(mm_uniq_prop, 6) AS mm_uniq_prop, round(mm_obs_cov, 6) AS mm_obs_cov, round(mm_exp_cov, 6) AS mm_exp_cov FROM mm3", _MINIMIZERS),
        "minimizer_corr": _q(
            f"SELECT t_id, round(r, 6) AS mm_pearson_corr, round({_p_value('r', 'n')}, 6) AS mm_pearson_p, n AS mm_pearson_n, round(rf, 6) AS mm_pearson_filtered_corr, round({_p_value('rf', 'nf')}, 6) AS mm_pearson_filtered_p, nf AS mm_pearson_filtered_n, "
            "mm_obs_cov_mean, mm_obs_cov_median, mm_obs_cov_stdev, mm_obs_cov_cv, mm_obs_cov_p05, mm_obs_cov_p95 FROM co", _MINIMIZERS, corr,
        ),
        "annotate_join": _q(
            "SELECT w.t_id, CASE WHEN w.t_id = 0 THEN 'unclassified' ELSE name END AS t_scientific_name, CASE WHEN w.t_id = 0 THEN 'no rank' ELSE rank END AS t_rank, t_superkingdom, t_phylum, t_species, "
            f"round(c_acctbal, 6) AS status, CASE WHEN n.t_id IS NOT NULL THEN 1000 + w.t_id % 9000 END AS status_two, round({mean}, 6) AS sig_avg, round({median}, 6) AS sig_med, {', '.join(chr(34) + y + chr(34) for y in _YEARS)} "
            "FROM wide w LEFT JOIN nodes n ON n.t_id = w.t_id LEFT JOIN lin ON lin.t_id = w.t_id LEFT JOIN customer ON 100000 + c_custkey = w.t_id", _WIDE, _LINEAGE,
        ),
        "sort_hierarchical": _q("SELECT w.t_id, CASE w.t_id WHEN 0 THEN 0 WHEN 100000000 THEN 1 WHEN 1 THEN 2 ELSE 3 END::INT AS first, lower(t_superkingdom) AS superkingdom, lower(t_phylum) AS phylum, lower(t_species) AS species FROM wide w LEFT JOIN lin ON lin.t_id = w.t_id", _WIDE, _LINEAGE),
        "sort_dfs": _q(dfs, _WIDE, weight(mean, "max")),
        "sort_dfs_unweighted": _q(dfs, _WIDE, weight("1.0", "sum")),
        "reads_by_clade": _q(f"SELECT read_id, anc AS target, sample_id || '_clade_' || anc || '_' || regexp_replace({name}, '[^A-Za-z0-9_.-]+', '_', 'g') AS set_name FROM reads JOIN clo USING (t_id) JOIN nodes n ON n.t_id = anc WHERE anc IN ({CLADE}, 100, 1000, 100001)"),
        "temporal_filter": _q("SELECT read_id, year, week, year || '_' || lpad(week::VARCHAR, 2, '0') AS period FROM reads WHERE (year, week) >= (1996, 12) AND year <= 1998"),
        "reads_in_period": _q(f"SELECT read_id, anc AS target FROM reads JOIN clo USING (t_id) WHERE anc = {CLADE} AND year >= 1996 AND (year, week) <= (1997, 20)"),
        "classified_files_read": _q("SELECT read_id::VARCHAR AS read_id, status, t_id, r1_len, r2_len, r1_len + r2_len AS total_len FROM reads"),
        "fastq_matched": _q("SELECT read_id, t_id, repeat('A', (read_id % 7 + 1)::INT) AS r1_seq, repeat('C', (read_id % 7 + 1)::INT) AS r2_seq, repeat('@', (read_id % 7 + 1)::INT) AS r1_qual FROM reads"),
        "fastq_repeated": _q(
            "SELECT a.id AS read_id, a.t_id, a.lengths, repeat('A', (b.k % 7 + 1)::INT) AS r1_seq, CASE WHEN a.id % 4 <> 0 THEN repeat('C', (b.k % 7 + 1)::INT) END AS r2_seq FROM "
            "(SELECT read_id AS k, read_id // 3 AS id, t_id, r1_len || '|' || r2_len AS lengths, row_number() OVER (PARTITION BY read_id // 3 ORDER BY read_id) AS n FROM reads) a LEFT JOIN "
            "(SELECT read_id AS k, read_id // 3 AS id, row_number() OVER (PARTITION BY read_id // 3 ORDER BY read_id) AS n FROM reads WHERE read_id % 5 <> 0) b ON a.id = b.id AND a.n = b.n"
        ),
        "named_files": _q(f"SELECT sample_id || '_clade_' || anc || '_' || regexp_replace({name}, '[^A-Za-z0-9_.-]+', '_', 'g') AS set_name, row_number() OVER (PARTITION BY sample_id, anc ORDER BY read_id) - 1 AS line, read_id FROM reads JOIN clo USING (t_id) JOIN nodes n ON n.t_id = anc WHERE anc IN ({CLADE}, 1000)"),
        "block_gzip_read": _q("SELECT read_id::VARCHAR AS read_id, status, t_id, r1_len, r2_len, r1_len + r2_len AS total_len FROM reads"),
        "kmer_bucketed_counts": _kmer_sql("global")["kmer_global_counts"],
        "price_quantiles": f"""
WITH r AS (SELECT l_returnflag, l_extendedprice::DOUBLE AS x, l_quantity::DOUBLE AS q FROM lineitem),
p AS (SELECT l_returnflag, {", ".join(f"round({e}, 4) AS price_{s}" for e, s in zip(("avg(x)", "median(x)", "stddev_samp(x)", "stddev_samp(x) / avg(x)", _nearest("x", 0.05), _nearest("x", 0.95)), STATISTICS, strict=True))} FROM r GROUP BY 1),
{_weighted("r", "l_returnflag", "x", "q", "wq").strip().rstrip(",")}
SELECT p.*, {", ".join(f"round({s}, 4) AS by_quantity_{s}" for s in STATISTICS)} FROM p JOIN wq USING (l_returnflag)""",
        **{f"audit_{mode}": audit(mode) for mode in ("taxon", "clade", "canonical")},
        "canonical_domain": _q("FROM canonical", _BARE, _canonical("classified")),
        "sort_domains": _q("SELECT w.t_id, CASE w.t_id WHEN 0 THEN 0 WHEN 100000000 THEN 1 WHEN 1 THEN 2 ELSE 3 END::INT AS first, lower(t_superkingdom) AS domain, lower(t_phylum) AS phylum, lower(t_species) AS species FROM wide w LEFT JOIN lin ON lin.t_id = w.t_id", _WIDE, _LINEAGE),
        "read_migration": _q(
            "SELECT rank, coalesce(max(x) FILTER (WHERE k = 0), 0)::BIGINT AS before, coalesce(max(x) FILTER (WHERE k = 1), 0)::BIGINT AS after, (coalesce(max(x) FILTER (WHERE k = 1), 0) - coalesce(max(x) FILTER (WHERE k = 0), 0))::BIGINT AS moved FROM ("
            "SELECT k, CASE WHEN t_id = 0 THEN 'unclassified' ELSE coalesce(n.rank, 'unknown') END AS rank, sum(taxon_reads) AS x FROM (SELECT 0 AS k, t_id, taxon_reads FROM counts UNION ALL SELECT 1, t_id, taxon_reads FROM pushed WHERE taxon_reads > 0) LEFT JOIN nodes n USING (t_id) GROUP BY ALL) GROUP BY rank", _pushed("counts"),
        ),
    }
