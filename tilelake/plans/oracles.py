"""SQL for DuckDB that gives the rows of the registered queries from raw pixels and tables."""

from __future__ import annotations

from tilelake.functions.color import HE_REF, IMAGENET_MEAN, IMAGENET_STD, MAXC_REF
from tilelake.plans.fixtures import MPP_CASES

_SHADES = ",\n".join(f"         CAST(floor(240e0 * exp(-({h}e0 * h + {k}e0 * k))) AS INT) AS {c}" for c, (h, k) in zip("rgb", HE_REF, strict=True))
PX = f"""
e AS (
  SELECT label AS slide_id, vec_id AS patch_id, CAST(p.pos AS INT) AS pos,
         4e0 * abs(round(CAST(embedding[p.pos + 1] AS DOUBLE), 3)) AS h, 4e0 * abs(round(CAST(embedding[(p.pos + 21) % 64 + 1] AS DOUBLE), 3)) AS k
  FROM embeddings, range(64) p(pos)),
px AS (SELECT slide_id, patch_id, pos,
{_SHADES}
  FROM e)"""
OD = "od AS (SELECT *, " + ", ".join(f"-ln(({c} + 1) / 240e0) AS o{c}" for c in "rgb") + " FROM px)"
TISSUE = "tis AS (SELECT * FROM od WHERE o_r >= 0.15e0 AND o_g >= 0.15e0 AND o_b >= 0.15e0)".replace("o_", "o")
_COV = [("c_rr", "r", "r"), ("c_rg", "r", "g"), ("c_rb", "r", "b"), ("c_gg", "g", "g"), ("c_gb", "g", "b"), ("c_bb", "b", "b")]

OD_TISSUE_STATS = f"WITH {PX}, {OD}, {TISSUE} SELECT slide_id, count(*) AS n_tissue, " + ", ".join(f"round(avg(o{c}), 6) AS mean_od_{c}" for c in "rgb") + ", " + ", ".join(f"round(covar_samp(o{a}, o{b}), 8) AS {n}" for n, a, b in _COV) + " FROM tis GROUP BY slide_id"
COLOR_HISTOGRAM = f"WITH {PX} SELECT slide_id, r, g, b, count(*) AS n FROM px GROUP BY ALL"
OD_PERCENTILES = f"WITH {PX}, {OD} SELECT slide_id, " + ", ".join(f"round(quantile_cont(o{c}, {q / 100}), 6) AS {c}_p{q}" for c in "rgb" for q in (1, 99)) + " FROM od GROUP BY slide_id"
OD_PERCENTILES_APPROX = f"WITH {PX}, {OD} SELECT slide_id, " + ", ".join(f"round(quantile_cont(round(\"o{c}\" * 4096) / 4096, 0.99), 6) AS od_{c}_p99" for c in "rgb") + " FROM od GROUP BY slide_id"
LINEITEM_PERCENTILES = (
    "WITH px AS (SELECT CAST(floor(l_quantity * 5) AS INT) AS r, CAST(floor(round(l_discount * 100) * 25) AS INT) AS g, CAST(floor(round(l_tax * 100) * 31) AS INT) AS b FROM lineitem), "
    + OD + " SELECT " + ", ".join(f"round(quantile_cont(o{c}, {q / 100}), 6) AS {c}_p{q}" for c in "rgb" for q in (1, 50, 99)) + ", count(*) AS n FROM od"
)


def _axes(source: str, flip_by_mean: bool = True, name: str = "") -> str:
    """CTEs from tissue rows (slide_id, or, og, ob) to sign-fixed unit eigenvectors m (middle) and t (largest)."""
    cov = ", ".join(f"covar_samp(o{x}, o{y}) AS {v}" for v, (x, y) in zip("adfehi", [("r", "r"), ("r", "g"), ("r", "b"), ("g", "g"), ("g", "b"), ("b", "b")], strict=True))
    vec = ", ".join(f"d * h - f * (e - {lam}) AS {p}r, f * d - (a - {lam}) * h AS {p}g, (a - {lam}) * (e - {lam}) - d * d AS {p}b" for p, lam in (("m", "l_mid"), ("t", "l_top")))
    unit = ", ".join(f"{p}{c} / sqrt({p}r * {p}r + {p}g * {p}g + {p}b * {p}b) AS {p}{c}" for p in "mt" for c in "rgb")
    if flip_by_mean:
        sign = ", ".join(f"{p}{c} * CASE WHEN {p}r * u_r + {p}g * u_g + {p}b * u_b < 0 THEN -1e0 ELSE 1e0 END AS {p}{c}" for p in "mt" for c in "rgb")
    else:
        sign = ", ".join(f"{p}{c} * CASE WHEN {p}r < 0 THEN -1e0 ELSE 1e0 END AS {p}{c}" for p in "mt" for c in "rgb")
    return f"""
cv AS (SELECT slide_id, count(*) AS n_tissue, avg("or") AS u_r, avg(og) AS u_g, avg(ob) AS u_b, {cov.replace("or,", '"or",').replace("(or", '("or"')} FROM {source} GROUP BY slide_id),
q1 AS (SELECT *, (a + e + i) / 3 AS q FROM cv),
q2 AS (SELECT *, sqrt(((a - q) * (a - q) + (e - q) * (e - q) + (i - q) * (i - q) + 2 * (d * d + f * f + h * h)) / 6) AS p FROM q1),
q3 AS (SELECT *, acos(greatest(-1e0, least(1e0, ((a - q) * ((e - q) * (i - q) - h * h) - d * (d * (i - q) - h * f) + f * (d * h - (e - q) * f)) / (p * p * p) / 2))) / 3 AS w FROM q2),
q4 AS (SELECT *, q + 2 * p * cos(w) AS l_top, q + 2 * p * cos(w + 2.0943951023931953e0) AS l_low FROM q3),
q5 AS (SELECT *, 3 * q - l_top - l_low AS l_mid FROM q4),
q6 AS (SELECT *, {vec} FROM q5),
q7 AS (SELECT slide_id, n_tissue, u_r, u_g, u_b, l_low, l_mid, l_top, {unit} FROM q6),
ax AS (SELECT slide_id, n_tissue, l_low, l_mid, l_top, {sign} FROM q7)"""


def _quoted(sql: str) -> str:
    """'or' is a keyword: the red optical density is named o_red."""
    import re

    return re.sub(r'"or"|\bor\b(?=\s*[*,)>+\-/<]|\s+AS\b|\s*FROM)', "o_red", sql)


def stain(what: str, exact: bool = True) -> str:
    phi = "phi" if exact else "round(phi * 4096) / 4096"
    dot = lambda p: f'(o_red * {p}r + og * {p}g + ob * {p}b)'
    parts = [PX, "od AS (SELECT *, -ln((r + 1) / 240e0) AS o_red, -ln((g + 1) / 240e0) AS og, -ln((b + 1) / 240e0) AS ob FROM px)", "tis AS (SELECT * FROM od WHERE o_red >= 0.15e0 AND og >= 0.15e0 AND ob >= 0.15e0)"]
    parts.append(_quoted(_axes("tis")))
    if what == "axes":
        return "WITH " + ",".join(parts) + " SELECT slide_id, round(l_low, 8) AS l_low, round(l_mid, 8) AS l_mid, round(l_top, 8) AS l_top FROM ax"
    parts.append(f"ph AS (SELECT slide_id, quantile_cont({phi}, 0.01) AS p0, quantile_cont({phi}, 0.99) AS p1 FROM (SELECT slide_id, atan2({dot('t')}, {dot('m')}) AS phi FROM tis JOIN ax USING (slide_id)) GROUP BY slide_id)")
    parts.append("vv AS (SELECT slide_id, n_tissue, " + ", ".join(f"m{c} * cos(p{k}) + t{c} * sin(p{k}) AS v{k}{c}" for k in (0, 1) for c in "rgb") + " FROM ax JOIN ph USING (slide_id))")
    parts.append("he AS (SELECT slide_id, n_tissue, " + ", ".join(f"CASE WHEN v0r > v1r THEN v{k}{c} ELSE v{1 - k}{c} END AS he_{c}{k + 1}" for k in (0, 1) for c in "rgb") + " FROM vv)")
    he = [f"he_{c}{k}" for k in (1, 2) for c in "rgb"]
    rounded = ", ".join(f"round({c}, 6) AS {c}" for c in he)
    if what == "vectors":
        return "WITH " + ",".join(parts) + f" SELECT slide_id, n_tissue, {rounded} FROM he"
    parts.append(_solve("od", "he", "0e0"))
    if what == "conc":
        return "WITH " + ",".join(parts) + " SELECT slide_id, r, g, b, count(*) AS n, any_value(CASE WHEN round(c_h, 6) = 0 THEN 0e0 ELSE round(c_h, 6) END) AS c_h, any_value(CASE WHEN round(c_e, 6) = 0 THEN 0e0 ELSE round(c_e, 6) END) AS c_e FROM cc GROUP BY slide_id, r, g, b"
    parts.append("mx AS (SELECT slide_id, quantile_cont(c_h, 0.99) AS maxc_h, quantile_cont(c_e, 0.99) AS maxc_e FROM cc GROUP BY slide_id)")
    if what == "maxc":
        return "WITH " + ",".join(parts) + " SELECT slide_id, round(maxc_h, 6) AS maxc_h, round(maxc_e, 6) AS maxc_e FROM mx"
    if what == "reference":
        return "WITH " + ",".join(parts) + f" SELECT {rounded}, round(maxc_h, 6) AS maxc_h, round(maxc_e, 6) AS maxc_e FROM he JOIN mx USING (slide_id) WHERE slide_id = 0"
    if what == "fitted":
        parts.append("rf AS (SELECT he.*, maxc_h AS ref_h, maxc_e AS ref_e FROM he JOIN mx USING (slide_id) WHERE slide_id = 0)")
        new = ", ".join(f"CAST(floor(least(255e0, 240e0 * exp(-(rf.he_{c}1 * (c_h / (maxc_h / ref_h)) + rf.he_{c}2 * (c_e / (maxc_e / ref_e)))))) AS INT) AS n{c}" for c in "rgb")
        parts.append(f"nn AS (SELECT cc.slide_id, patch_id, pos, r, g, b, {new} FROM cc JOIN mx USING (slide_id), rf)")
    else:
        new = ", ".join(f"CAST(floor(least(255e0, 240e0 * exp(-({HE_REF[k][0]}e0 * (c_h / (maxc_h / {MAXC_REF[0]}e0)) + {HE_REF[k][1]}e0 * (c_e / (maxc_e / {MAXC_REF[1]}e0)))))) AS INT) AS n{c}" for k, c in enumerate("rgb"))
        parts.append(f"nn AS (SELECT slide_id, patch_id, pos, r, g, b, {new} FROM cc JOIN mx USING (slide_id))")
    if what == "pixels":
        return "WITH " + ",".join(parts) + " SELECT slide_id, patch_id, pos, nr, ng, nb FROM nn"
    if what == "pixels_packed":
        hexes = " || ".join(f"lpad(to_hex(n{c}), 2, '0')" for c in "rgb")
        return "WITH " + ",".join(parts) + f" SELECT slide_id, patch_id, upper(string_agg({hexes}, '' ORDER BY pos)) AS normalized FROM nn GROUP BY slide_id, patch_id"
    return "WITH " + ",".join(parts) + " SELECT slide_id, r, g, b, count(*) AS n, any_value(nr) AS nr, any_value(ng) AS ng, any_value(nb) AS nb FROM nn GROUP BY slide_id, r, g, b"


def _solve(od: str, he: str, lam: str) -> str:
    return f"""
g1 AS (SELECT slide_id, he_r1 * he_r1 + he_g1 * he_g1 + he_b1 * he_b1 AS g11, he_r1 * he_r2 + he_g1 * he_g2 + he_b1 * he_b2 AS g12, he_r2 * he_r2 + he_g2 * he_g2 + he_b2 * he_b2 AS g22, {", ".join(f"he_{c}{k}" for k in (1, 2) for c in "rgb")} FROM {he}),
g2 AS (SELECT o.*, g11, g12, g22, g11 * g22 - g12 * g12 AS det, he_r1 * o_red + he_g1 * og + he_b1 * ob - {lam} AS b1, he_r2 * o_red + he_g2 * og + he_b2 * ob - {lam} AS b2 FROM {od} o JOIN g1 USING (slide_id)),
cc AS (SELECT *, (g22 * b1 - g12 * b2) / det AS c_h, (g11 * b2 - g12 * b1) / det AS c_e FROM g2)"""


def sparse(what: str) -> str:
    parts = [PX, "od AS (SELECT *, -ln(greatest(r, 1) / 255e0) AS o_red, -ln(greatest(g, 1) / 255e0) AS og, -ln(greatest(b, 1) / 255e0) AS ob FROM px)", "tis AS (SELECT * FROM od WHERE o_red > 0.15e0 OR og > 0.15e0 OR ob > 0.15e0)"]
    parts.append(_quoted(_axes("tis", False)))
    parts.append("ph AS (SELECT slide_id, quantile_cont(phi, 0.01) AS p0, quantile_cont(phi, 0.99) AS p1 FROM (SELECT slide_id, atan2(o_red * mr + og * mg + ob * mb, o_red * tr + og * tg + ob * tb) AS phi FROM tis JOIN ax USING (slide_id)) GROUP BY slide_id)")
    parts.append("vv AS (SELECT slide_id, " + ", ".join(f"t{c} * cos(p{k}) + m{c} * sin(p{k}) AS v{k}{c}" for k in (0, 1) for c in "rgb") + " FROM ax JOIN ph USING (slide_id))")
    parts.append("h0 AS (SELECT slide_id, " + ", ".join(f"CASE WHEN v0r > v1r THEN v{k}{c} ELSE v{1 - k}{c} END AS z{c}{k + 1}" for k in (0, 1) for c in "rgb") + " FROM vv)")
    parts.append("he AS (SELECT slide_id, " + ", ".join(f"z{c}{k} / sqrt(zr{k} * zr{k} + zg{k} * zg{k} + zb{k} * zb{k}) AS he_{c}{k}" for k in (1, 2) for c in "rgb") + " FROM h0)")
    if what == "vectors":
        return "WITH " + ",".join(parts) + " SELECT slide_id, " + ", ".join(f"round(he_{c}{k}, 6) AS he_{c}{k}" for k in (1, 2) for c in "rgb") + " FROM he"
    parts.append(_solve("od", "he", "0.01e0").replace("cc AS (SELECT *,", "c0 AS (SELECT *,").replace("AS c_h,", "AS x1,").replace("AS c_e FROM", "AS x2, greatest(b1 / g11, 0e0) AS y1, greatest(b2 / g22, 0e0) AS y2 FROM"))
    pick = "y1 * b1 - 0.5e0 * y1 * y1 * g11 >= y2 * b2 - 0.5e0 * y2 * y2 * g22"
    parts.append(f"cc AS (SELECT *, CASE WHEN x1 >= 0 AND x2 >= 0 THEN x1 WHEN {pick} THEN y1 ELSE 0e0 END AS c_h, CASE WHEN x1 >= 0 AND x2 >= 0 THEN x2 WHEN {pick} THEN 0e0 ELSE y2 END AS c_e FROM c0)")
    new = ", ".join(f"any_value(CAST(floor(greatest(0e0, least(255e0, 255e0 * exp(-({HE_REF[k][0]}e0 * c_h + {HE_REF[k][1]}e0 * c_e))))) AS INT)) AS n{c}" for k, c in enumerate("rgb"))
    return "WITH " + ",".join(parts) + f" SELECT slide_id, r, g, b, count(*) AS n, any_value(CASE WHEN round(c_h, 6) = 0 THEN 0e0 ELSE round(c_h, 6) END) AS c_h, any_value(CASE WHEN round(c_e, 6) = 0 THEN 0e0 ELSE round(c_e, 6) END) AS c_e, {new} FROM cc GROUP BY slide_id, r, g, b"


OD_TISSUE_STATS = OD_TISSUE_STATS.replace(" AS or", " AS o_red").replace(" or >=", " o_red >=").replace("(or", "(o_red").replace(", or)", ", o_red)")
OD_PERCENTILES = OD_PERCENTILES.replace(" AS or", " AS o_red").replace("(or", "(o_red")
LINEITEM_PERCENTILES = LINEITEM_PERCENTILES.replace(" AS or", " AS o_red").replace("(or", "(o_red")

BRIGHTNESS = f"WITH {PX}, p AS (SELECT slide_id, quantile_cont(v, 0.9) AS p90 FROM (SELECT slide_id, unnest([r, g, b]) AS v FROM px) GROUP BY slide_id) SELECT slide_id, r, g, b, count(*) AS n, " + ", ".join(f"any_value(CAST(floor(greatest(0e0, least(255e0, {c} * 255e0 / p90))) AS INT)) AS s{c}" for c in "rgb") + " FROM px JOIN p USING (slide_id) GROUP BY slide_id, r, g, b"

PT = "pt AS (SELECT label AS slide_id, CAST(vec_id // 16 AS INT) AS \"row\", CAST(vec_id % 16 AS INT) AS col, embedding[1] >= 0 AS fg FROM embeddings)"
PATCH_COORDS = f'WITH {PT} SELECT slide_id, "row", col, CAST(col * 224 AS INT) AS x, CAST("row" * 224 AS INT) AS y FROM pt'
PATCH_FLATTEN = """
WITH s AS (SELECT CAST(s_suppkey AS VARCHAR) AS slide_id, (s_suppkey % 7 * 100 + 230) // 224 AS n_w, (s_suppkey % 5 * 150 + 100) // 224 AS n_h FROM supplier)
SELECT slide_id, CAST(i // n_w AS INT) AS "row", CAST(i % n_w AS INT) AS col, CAST(i AS INT) AS flat_idx, CAST(i % n_w * 224 AS INT) AS x, CAST(i // n_w * 224 AS INT) AS y
FROM s, range(1000) t(i) WHERE i < n_w * n_h"""
PATCHIFY = f'WITH {PX} SELECT slide_id, patch_id, CAST(pos // 8 // 4 AS INT) AS "row", CAST(pos % 8 // 4 AS INT) AS col, CAST(pos // 8 % 4 AS INT) AS dy, CAST(pos % 8 % 4 AS INT) AS dx, r FROM px'
RGB_TO_GRAY = f"WITH {PX} SELECT slide_id, patch_id, pos, CAST(floor(0.299e0 * r + 0.587e0 * g + 0.114e0 * b) AS INT) AS gray FROM px"
CHANNEL_SWAP = f"WITH {PX} SELECT slide_id, patch_id, pos, b AS c0, r AS c2 FROM px"
CHANNEL_NORMALIZE = f"WITH {PX} SELECT slide_id, patch_id, pos, " + ", ".join(f"round(({c} / 255e0 - {m}e0) / {s}e0, 6) AS {c}_norm" for c, m, s in zip("rgb", IMAGENET_MEAN, IMAGENET_STD, strict=True)) + " FROM px"
FOREGROUND_FILTER = f'WITH {PT} SELECT slide_id, "row", col FROM pt WHERE fg'
PATCH_INDEX_GRID = f'WITH {PT} SELECT slide_id, "row", col, CAST(CASE WHEN fg THEN sum(CASE WHEN fg THEN 1 ELSE 0 END) OVER (PARTITION BY slide_id ORDER BY "row", col ROWS UNBOUNDED PRECEDING) - 1 ELSE -1 END AS INT) AS patch_index FROM pt'
MOSAIC_BOUNDS = f'WITH {PT} SELECT slide_id, CAST(max(col * 224) + 224 AS INT) AS width, CAST(max("row" * 224) + 224 AS INT) AS height FROM pt GROUP BY slide_id'
MOSAIC_PIXELS = f"""
WITH {PX},
pp AS (SELECT slide_id, patch_id % 16 * 8 + pos % 8 AS px, patch_id // 16 * 8 + pos // 8 AS py, r, g, b FROM px),
sz AS (SELECT slide_id, max(patch_id % 16 * 8) + 8 AS w, max(patch_id // 16 * 8) + 8 AS h FROM px GROUP BY slide_id),
cv AS (SELECT slide_id, x.i AS px, y.i AS py FROM sz, LATERAL (SELECT unnest(range(w)) AS i) x, LATERAL (SELECT unnest(range(h)) AS i) y)
SELECT slide_id, CAST(px AS INT) AS px, CAST(py AS INT) AS py, coalesce(r, 0) AS r, coalesce(g, 0) AS g, coalesce(b, 0) AS b FROM cv LEFT JOIN pp USING (slide_id, px, py)"""
RECONSTRUCT = "SELECT label AS slide_id, CAST(max(vec_id % 16 * 8) + 8 AS INT) AS width, CAST(max(vec_id // 16 * 8) + 8 AS INT) AS height, CAST((max(vec_id % 16 * 8) + 8) * (max(vec_id // 16 * 8) + 8) * 3 AS BIGINT) AS bytes FROM embeddings GROUP BY label"


def _gradient() -> str:
    at = lambda y, x: f"v[greatest(0, least(7, y + ({y}))) * 8 + greatest(0, least(7, x + ({x}))) + 1]"
    dx = " + ".join(f"{w} * ({at(y, 1)} - {at(y, -1)})" for y, w in ((-1, 1), (0, 2), (1, 1)))
    dy = " + ".join(f"{w} * ({at(1, x)} - {at(-1, x)})" for x, w in ((-1, 1), (0, 2), (1, 1)))
    return f"""
WITH {PX},
ch AS (SELECT slide_id, patch_id, pos, unnest(['r', 'g', 'b']) AS c, unnest([r, g, b]) AS s FROM px),
im AS (SELECT slide_id, patch_id, c, list(s ORDER BY pos) AS v FROM ch GROUP BY ALL),
gr AS (SELECT slide_id, patch_id, y * 8 + x AS pos, abs({dx}) + abs({dy}) AS m FROM im, range(8) a(y), range(8) b(x))
SELECT slide_id, patch_id, CAST(pos AS INT) AS pos, CAST(max(m) AS INT) AS magnitude FROM gr GROUP BY ALL"""


GRADIENT = _gradient()


def _canny() -> str:
    """Edges of the packed patches: thinning by lists, hysteresis by recursion from strong pixels to weak neighbours."""
    at = lambda y, x: f"v[greatest(0, least(7, y + ({y}))) * 8 + greatest(0, least(7, x + ({x}))) + 1]"
    dx = " + ".join(f"{w} * ({at(y, 1)} - {at(y, -1)})" for y, w in ((-1, 1), (0, 2), (1, 1)))
    dy = " + ".join(f"{w} * ({at(1, x)} - {at(-1, x)})" for x, w in ((-1, 1), (0, 2), (1, 1)))
    near = lambda y, x: f"(CASE WHEN y + ({y}) BETWEEN 0 AND 7 AND x + ({x}) BETWEEN 0 AND 7 THEN ms[(y + ({y})) * 8 + x + ({x}) + 1] ELSE 0 END)"
    return f"""
WITH RECURSIVE {PX},
ch AS (SELECT slide_id, patch_id, pos, unnest([0, 1, 2]) AS c, unnest([r, g, b]) AS s FROM px),
im AS (SELECT slide_id, patch_id, c, list(s ORDER BY pos) AS v FROM ch GROUP BY ALL),
gr AS (SELECT slide_id, patch_id, c, y, x, {dx} AS dx, {dy} AS dy FROM im, range(8) a(y), range(8) b(x)),
st AS (SELECT *, abs(dx) + abs(dy) AS m FROM gr QUALIFY row_number() OVER (PARTITION BY slide_id, patch_id, y, x ORDER BY abs(dx) + abs(dy) DESC, c) = 1),
ml AS (SELECT slide_id, patch_id, list(m ORDER BY y * 8 + x) AS ms FROM st GROUP BY ALL),
wk AS (SELECT slide_id, patch_id, y, x, m FROM st JOIN ml USING (slide_id, patch_id)
  WHERE m > 40 AND CASE
    WHEN abs(dy) * 32768 < abs(dx) * 13573 THEN m > {near(0, -1)} AND m >= {near(0, 1)}
    WHEN abs(dy) * 32768 > abs(dx) * 13573 + abs(dx) * 65536 THEN m > {near(-1, 0)} AND m >= {near(1, 0)}
    WHEN (dx < 0) <> (dy < 0) THEN m > {near(-1, 1)} AND m > {near(1, -1)}
    ELSE m > {near(-1, -1)} AND m > {near(1, 1)} END),
ed AS (
  SELECT slide_id, patch_id, y, x FROM wk WHERE m > 100
  UNION
  SELECT wk.slide_id, wk.patch_id, wk.y, wk.x FROM ed JOIN wk ON ed.slide_id = wk.slide_id AND ed.patch_id = wk.patch_id AND abs(ed.y - wk.y) <= 1 AND abs(ed.x - wk.x) <= 1),
n AS (SELECT slide_id, patch_id, count(*) AS k FROM ed GROUP BY ALL)
SELECT slide_id, patch_id, CAST(coalesce(k, 0) AS INT) AS edge_px, NOT (coalesce(k, 0) * 100e0 / 192 < 2) AS is_foreground FROM ml LEFT JOIN n USING (slide_id, patch_id)"""


CANNY = _canny()


def _resample() -> str:
    """8 x 8 tiles to 12 x 12 in single precision, cut into patches of 6."""
    at = "((i + 0.5e0) * 8 / 12 - 0.5e0)"
    mixed = lambda a, b, f: f"({a}) * (CAST(1 AS FLOAT) - {f}) + ({b}) * {f}"
    v = lambda y, x: f"CAST(v[{y} * 8 + {x} + 1] AS FLOAT)"
    row = lambda x: mixed(v("a.lo", x), v("a.hi", x), "a.f")
    return f"""
WITH {PX},
ch AS (SELECT slide_id, patch_id, pos, unnest([0, 1, 2]) AS c, unnest([r, g, b]) AS s FROM px),
im AS (SELECT slide_id, patch_id, c, list(s ORDER BY pos) AS v FROM ch GROUP BY ALL),
ax AS (SELECT CAST(i AS INT) AS i, greatest(0, least(7, CAST(floor({at}) AS INT))) AS lo, greatest(0, least(7, CAST(floor({at}) AS INT) + 1)) AS hi, CAST({at} - floor({at}) AS FLOAT) AS f FROM range(12) t(i)),
o AS (SELECT slide_id, patch_id, c, a.i AS oy, b.i AS ox, CAST(round_even({mixed(row("b.lo"), row("b.hi"), "b.f")}, 0) AS INT) AS s FROM im, ax a, ax b),
p AS (SELECT slide_id, CAST(patch_id // 16 * 2 + oy // 6 AS INT) AS "row", CAST(patch_id % 16 * 2 + ox // 6 AS INT) AS col, oy % 6 * 18 + ox % 6 * 3 + c AS k, s FROM o)
SELECT CAST(slide_id AS VARCHAR) AS slide_id, "row", col, col * 6 AS x, "row" * 6 AS y, upper(string_agg(lpad(to_hex(s), 2, '0'), '' ORDER BY k)) AS rgb, true AS ok FROM p GROUP BY ALL"""


RESAMPLE = _resample()


def _text(x: str | None) -> str:
    return "NULL" if x is None else "'" + x.replace("'", "''") + "'"


def _mpp() -> str:
    keys = ["openslide.mpp-x", "tiff.ImageDescription", "openslide.comment", "tiff.XResolution", "tiff.YResolution", "tiff.ResolutionUnit"]
    rows = ", ".join(f"({_text(n)}, " + ", ".join(_text(p.get(k)) for k in keys) + ")" for n, p in MPP_CASES)
    num = lambda e: f"CASE WHEN try_cast({e} AS DOUBLE) > 0 THEN try_cast({e} AS DOUBLE) END"
    # elements are balanced: as many starts as ends; then the first Pixels of the first Image
    whole = "len(regexp_extract_all(descr, '<[A-Za-z]')) = len(regexp_extract_all(descr, '</[A-Za-z]')) + len(regexp_extract_all(descr, '/>'))"
    image = """regexp_extract(descr, '<Image[^>]*/>|<Image.*?</Image>')"""
    size = f"""regexp_extract(regexp_extract({image}, '<Pixels.*'), 'PhysicalSizeX="([^"]*)"', 1)"""
    return f"""
WITH c(name, prop, descr, comm, xres, yres, unit) AS (VALUES {rows}),
m AS (SELECT *, coalesce({num("prop")}, CASE WHEN {whole} THEN {num(size)} END,
  {num("regexp_extract(comm, '<PixelSizeMicrons>(.*?)</PixelSizeMicrons>', 1)")},
  CASE WHEN ({num("yres")}) IS NOT NULL THEN CASE unit WHEN 'centimeter' THEN 10000 / ({num("xres")}) WHEN 'inch' THEN 25400 / ({num("xres")}) END END) AS mpp FROM c)
SELECT name, round(mpp, 6) AS mpp, CASE WHEN mpp IS NULL THEN 'mpp_extraction_error' ELSE 'ok' END AS status, coalesce(try_cast(xres AS DOUBLE) <> try_cast(yres AS DOUBLE), false) AS differs FROM m"""


MPP_CHAIN = _mpp()
BEST_LEVEL = """
WITH s AS (SELECT o_orderkey AS k, [1e0, CAST(o_orderkey % 3 + 2 AS DOUBLE), CAST(o_orderkey % 5 + 6 AS DOUBLE)] AS ds, 2e0 / (0.25e0 + o_orderkey % 4 * 0.25e0) AS target, CASE WHEN o_orderkey % 4 > 0 THEN o_orderkey % 4 - 1 END AS asked FROM orders),
l AS (SELECT k, asked, i, abs(ds[i + 1] - target) AS gap FROM s, range(3) t(i)),
p AS (SELECT k, any_value(asked) AS asked, arg_min(i, gap * 1e6 + i * 1e-3) AS proposed FROM l GROUP BY k)
SELECT k, CAST(proposed AS INT) AS proposed, CAST(CASE WHEN asked IS NULL THEN proposed ELSE least(asked, proposed) END AS INT) AS level, coalesce(asked > proposed, false) AS clamped FROM p"""
TILE_SIZE = """
WITH s AS (SELECT o_orderkey AS k, (0.25e0 + o_orderkey % 7 * 0.05e0) * pow(2e0, o_orderkey % 3) AS level_mpp FROM orders),
t AS (SELECT k, level_mpp, CAST(ceil(3584 * (256e0 / 224e0) / level_mpp) AS INT) AS tile FROM s)
SELECT k, tile, round(tile / 3584e0 * level_mpp, 6) AS effective_mpp, CAST(ceil((k % 9000 + 1) / CAST(tile AS DOUBLE)) * tile AS INT) AS padded, CAST(floor(k % 11 * pow(2e0, k % 3) * tile) AS BIGINT) AS ref_x FROM t"""
CHUNK_KEYS = """
WITH s AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 10 = 0 THEN 'bad/' || o_orderkey ELSE (o_orderkey % 4) || '/' || (o_orderkey % 13) || '.' || (o_orderkey % 17) || '.0' END AS key FROM orders),
p AS (SELECT k, CASE WHEN key NOT LIKE 'bad%' THEN CAST(split_part(key, '/', 1) AS INT) END AS level, CASE WHEN key NOT LIKE 'bad%' THEN CAST(split_part(split_part(key, '/', 2), '.', 1) AS INT) END AS y, CASE WHEN key NOT LIKE 'bad%' THEN CAST(split_part(split_part(key, '/', 2), '.', 2) AS INT) END AS x FROM s)
SELECT k, coalesce(level, -1) AS level, coalesce(y, -1) AS y, coalesce(x, -1) AS x, coalesce(level < 3 AND y * 10 < ([100, 50, 25])[level + 1] AND x * 10 < ([100, 50, 25])[level + 1], false) AS present FROM p"""
STEMS = "SELECT 'in/s' || o_orderkey || '.svs' AS path, 's' || o_orderkey AS stem FROM orders"
MULTISCALE = """SELECT * FROM (VALUES ('a', '{"multiscales":[{"name":"","datasets":[{"path":"0"},{"path":"1"}],"version":"0.1"}]}'), ('b', '{"multiscales":[{"name":"","datasets":[{"path":"0"}],"version":"0.1"}]}')) v(name, attrs)"""
PENDING = "SELECT 'in/s' || o_orderkey || '.svs' AS path FROM orders WHERE o_orderstatus = 'O' ORDER BY path"
PENDING_RETRY = "SELECT 'in/s' || o_orderkey || '.svs' AS path FROM orders WHERE o_orderstatus <> 'F' ORDER BY path"
STATUS_SUMMARY = "SELECT o_orderstatus AS status, count(*) AS n, round(avg(CASE WHEN o_orderstatus <> 'P' THEN o_orderkey % 100 * 0.5e0 END), 6) AS mean_elapsed_s FROM orders GROUP BY 1"
TILE_SCAN = """
WITH l(level, w, h) AS (VALUES (0, 100, 70), (1, 50, 35))
SELECT level, CAST(y.i AS INT) AS tile_y, CAST(x.i AS INT) AS tile_x, 32 AS height, 32 AS width, CAST(32 * 32 * 3 AS BIGINT) AS bytes, true AS ok
FROM l, range(4) x(i), range(4) y(i) WHERE x.i * 32 < w AND y.i * 32 < h"""


def _embedding() -> str:
    """Normalised channels of all pixels in single precision, then shares of 576 colour codes."""
    f = lambda x: f"CAST({x} AS FLOAT)"
    channels = ", ".join(f"({f(c)} / {f('255')} - {f(repr(m))}) / {f(repr(d))}" for c, m, d in zip("rgb", IMAGENET_MEAN, IMAGENET_STD, strict=True))
    return f"""
WITH {PX},
p AS (SELECT slide_id, patch_id, flatten(list([{channels}] ORDER BY pos)) AS pooled, list((r >> 5) * 72 + (g >> 5) * 9 + b // 29) AS codes FROM px GROUP BY ALL)
SELECT slide_id, patch_id, list_transform(list_concat(pooled, list_transform(range(576), lambda k: CAST(len(list_filter(codes, lambda c: c = k)) / 64e0 AS FLOAT))), lambda x: round(CAST(x AS DOUBLE), 4)) AS embedding FROM p"""


EMBEDDING = _embedding()

ZARR_GROUPS = f"""
WITH {PX},
pp AS (SELECT patch_id, string_agg(printf('%02X%02X%02X', r, g, b), '' ORDER BY pos) AS pixels FROM px GROUP BY patch_id)
SELECT 's' || label AS stem, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS idx, pixels FROM embeddings JOIN pp ON patch_id = vec_id WHERE embedding[1] >= 0"""
WINDOW_TOKENS = f"""
WITH {PX}, s AS (SELECT *, (pos // 8 + 6) % 8 AS y, (pos + 6) % 8 AS x FROM px)
SELECT slide_id, patch_id, CAST(y // 4 * 2 + x // 4 AS INT) AS "window", CAST(y % 4 * 4 + x % 4 AS INT) AS token, r, g, b FROM s"""
MERGED_TOKENS = f"""
WITH {PX}
SELECT slide_id, patch_id, CAST(pos // 16 * 4 + pos % 8 // 2 AS INT) AS token, flatten(list([r, g, b] ORDER BY pos % 2, pos // 8)) AS channels FROM px GROUP BY ALL"""
POOLED_TOKENS = f"WITH {PX} SELECT slide_id, patch_id, round(avg(r), 6) AS r, round(avg(g), 6) AS g, round(avg(b), 6) AS b FROM px GROUP BY ALL"
LAYER_NORM = """
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings),
m AS (SELECT *, list_avg(e) AS mean, list_var_pop(e) AS var FROM e)
SELECT vec_id, list_transform(e, lambda x: round((x - mean) / sqrt(var + 1e-5) * 2 + 0.5, 4) + 0e0) AS normed FROM m"""
RELATIVE_INDEX = "SELECT CAST(a AS INT) AS a, CAST(b AS INT) AS b, CAST((a // 7 - b // 7 + 6) * 13 + a % 7 - b % 7 + 6 AS INT) AS bias_row FROM range(49) i(a), range(49) j(b)"
SHIFT_MASK = """
WITH t AS (SELECT w, t, w // 2 = 1 AND t // 7 >= 4 AS low, w % 2 = 1 AND t % 7 >= 4 AS far FROM range(4) i(w), range(49) j(t))
SELECT CAST(p.w AS INT) AS "window", CAST(p.t AS INT) AS a, CAST(q.t AS INT) AS b FROM t p JOIN t q ON p.w = q.w AND p.low = q.low AND p.far = q.far"""

#: Slides of the end-to-end queries: URL, width, height, resolution (none: not known).
SLIDES = [("synthetic://300x200?seed=1&levels=2&mpp=2.0", 300, 200, 2.0), ("synthetic://100x90?seed=2&mpp=1.0", 100, 90, 1.0), ("synthetic://64x64?seed=3", 64, 64, None), ("nowhere.svs", None, None, None)]
_SLIDES = "s(path, w, h, mpp) AS (VALUES " + ", ".join(f"({_text(p)}, {w or 'NULL'}, {h or 'NULL'}, {f'{m}e0' if m else 'NULL'})" for p, w, h, m in SLIDES) + ")"
SLIDE_HEADERS = f"""
WITH {_SLIDES}
SELECT path, mpp, CASE WHEN mpp IS NOT NULL THEN 0 END AS level, CASE WHEN mpp IS NOT NULL THEN CAST(ceil(128 * 2e0 / mpp) AS INT) END AS tile,
       CASE WHEN w IS NULL THEN 'load_error' WHEN mpp IS NULL THEN 'mpp_extraction_error' ELSE 'ok' END AS status FROM s"""
PROCESS_SLIDES = f"""
WITH {_SLIDES},
t AS (SELECT path, CAST(ceil(w / ceil(256 / mpp)) * ceil(h / ceil(256 / mpp)) * 256 AS BIGINT) AS patches FROM s WHERE mpp IS NOT NULL)
SELECT path, CASE WHEN w IS NULL THEN 'load_error' WHEN mpp IS NULL THEN 'mpp_extraction_error' ELSE 'done' END AS status, coalesce(patches, 0) AS grid_cells,
       true AS tables_agree FROM s LEFT JOIN t USING (path)"""
