"""The isolation forest in SQL: the same digests give the same samples, cuts and scores."""

from __future__ import annotations

from meterflow.operators.forest import DECIMALS, PRIME, SAMPLE

LEVELS = 8  # of a tree over SAMPLE rows


def _share(*parts: str) -> str:
    return f"(('0x' || substr(md5(concat_ws('|', {', '.join(parts)})), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE)"


def forest_sql(name: str, source: str, key: str, inputs: tuple[str, ...], *, trees: int = 100, max_features: float = 1.0,
               seed: int = 42, fit: str = "TRUE", prefixes: tuple[int, ...] = ()) -> str:
    """``{name}``: the rows of ``source`` with ``raw``, the score of the forest fitted where ``fit`` holds.

    With ``prefixes`` there is a row for each of them, ``count``, scored by as many first trees.
    """
    n, dims = name, len(inputs)
    values = ", ".join(f'round(CAST("{c}" AS DOUBLE), {DECIMALS})' for c in inputs)
    mean_path = "CASE WHEN c > 2 THEN 2 * (ln(c - 1) + 0.5772156649015329::DOUBLE) - 2 * (c - 1) / c::DOUBLE WHEN c = 2 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END"
    parts = [f"""{n}_rows AS MATERIALIZED (SELECT *, row_number() OVER () AS {n}_id, [{values}] AS x, {fit} AS fits, md5('{seed}|' || {key}) AS h FROM {source}),
{n}_size AS MATERIALIZED (SELECT least({SAMPLE}, count(*)) AS psi, CASE WHEN count(*) > 1 THEN ceil(log2(least({SAMPLE}, count(*))))::INT ELSE 1 END AS deep
  FROM {n}_rows WHERE fits),
{n}_trees AS (SELECT unnest(range({trees})) AS t),
{n}_allowed AS MATERIALIZED (SELECT t, f FROM {n}_trees, (SELECT unnest(range({dims})) AS f)
  QUALIFY row_number() OVER (PARTITION BY t ORDER BY {_share(str(seed), "t", "f", "'subset'")}, f) <= {max(1, int(max_features * dims))}),
{n}_drawn AS (SELECT t, x, h, (('0x' || substr(h, 1, 13))::BIGINT + t * ('0x' || substr(h, 14, 13))::BIGINT) % {PRIME} AS draw FROM {n}_rows, {n}_trees WHERE fits),
{n}_0 AS MATERIALIZED (SELECT t, 1 AS node, x FROM {n}_drawn, {n}_size QUALIFY row_number() OVER (PARTITION BY t ORDER BY draw, h, x) <= psi)"""]
    for d in range(LEVELS):
        parts.append(f"""{n}_span_{d} AS (SELECT t, node, f, min(x[f + 1]) AS lo, max(x[f + 1]) AS hi FROM {n}_{d} JOIN {n}_allowed USING (t), {n}_size
  WHERE node >= {1 << d} AND {d} < deep GROUP BY t, node, f HAVING min(x[f + 1]) < max(x[f + 1])),
{n}_cut_{d} AS MATERIALIZED (SELECT t, node, f, CASE WHEN lo + u * (hi - lo) >= hi THEN lo ELSE lo + u * (hi - lo) END AS cut FROM (
  SELECT *, {_share(str(seed), "t", "node", "'cut'")} AS u FROM {n}_span_{d}
  QUALIFY row_number() OVER (PARTITION BY t, node ORDER BY f) - 1 = floor({_share(str(seed), "t", "node", "'feature'")} * count(*) OVER (PARTITION BY t, node)))),
{n}_{d + 1} AS MATERIALIZED (SELECT a.t, CASE WHEN c.t IS NULL THEN a.node ELSE 2 * a.node + (x[f + 1] > cut)::INT END AS node, x
  FROM {n}_{d} a LEFT JOIN {n}_cut_{d} c USING (t, node)),
{n}_walk_{d + 1} AS MATERIALIZED (SELECT a.id, a.t, CASE WHEN c.t IS NULL THEN a.node ELSE 2 * a.node + (x[f + 1] > cut)::INT END AS node, x
  FROM {f"(SELECT {n}_id AS id, t, 1 AS node, x FROM {n}_rows, {n}_trees)" if d == 0 else f"{n}_walk_{d}"} a LEFT JOIN {n}_cut_{d} c USING (t, node))""")
    counts = f"(SELECT unnest([{', '.join(map(str, prefixes or (trees,)))}]) AS count)"
    parts.append(f"""{n}_leaf AS MATERIALIZED (SELECT t, node, length(bin(node)) - 1 + {mean_path} AS path FROM (SELECT t, node, count(*) AS c FROM {n}_{LEVELS} GROUP BY t, node)),
{n}_scale AS (SELECT coalesce(nullif({mean_path}, 0), 1) AS scale FROM (SELECT psi AS c FROM {n}_size)),
{n}_paths AS (SELECT id, count, sum(path) AS path FROM {n}_walk_{LEVELS} JOIN {n}_leaf USING (t, node) JOIN {counts} ON t < count GROUP BY id, count),
{n} AS MATERIALIZED (SELECT r.* EXCLUDE (x, h, fits, {n}_id), fits, count, pow(2.0::DOUBLE, -path / count / scale) AS raw
  FROM {n}_rows r JOIN {n}_paths p ON p.id = r.{n}_id, {n}_scale)""")
    return ", ".join(parts)


def shifted_sql(name: str, contamination: float, out: str) -> str:
    """``{out}``: the rows of ``{name}`` with the score shifted so that 0 is the contamination cut-off, and its flag."""
    return f"""{out}_cut AS (SELECT quantile_cont(raw, {1.0 - contamination!r}::DOUBLE) AS offset_ FROM {name} WHERE fits),
{out} AS MATERIALIZED (SELECT *, CASE WHEN score > 0 THEN 1 ELSE 0 END AS forest_flag FROM (SELECT s.*, round(raw - offset_, 12) AS score FROM {name} s, {out}_cut))"""
