"""SQL for iterative operators: their rounds written out as chained CTEs."""

from __future__ import annotations


def hash60(seed: object, *columns: str) -> str:
    text = ", ".join([f"'{seed}'", *columns])
    return f"('0x' || substr(md5(concat_ws('|', {text})), 1, 15))::BIGINT"


def uniform(seed: object, *columns: str) -> str:
    return f"({hash60(seed, *columns)} / {float(2**60)!r}::DOUBLE)"


def canonical(source: str, name: str = "pairs", columns: str = "") -> str:
    return f"""{name} AS MATERIALIZED (
  SELECT DISTINCT least(src, dst) AS src, greatest(src, dst) AS dst{columns} FROM {source} WHERE src <> dst)"""


def pagerank(source: str, rounds: int) -> str:
    """CTEs up to ``ranks(id, pagerank)``."""
    parts = [
        f"links AS MATERIALIZED (SELECT src, dst, count(*) AS copies FROM {source} GROUP BY ALL)",
        "ids AS MATERIALIZED (SELECT src AS id FROM links UNION SELECT dst FROM links)",
        "degree AS MATERIALIZED (SELECT src, sum(copies) AS d FROM links GROUP BY src)",
        "weights AS MATERIALIZED (SELECT src, dst, copies / d AS w FROM links JOIN degree USING (src))",
        "r0 AS MATERIALIZED (SELECT id, 1.0::DOUBLE AS rank FROM ids)",
    ]
    for i in range(1, rounds + 1):
        parts.append(f"""r{i} AS MATERIALIZED (
  SELECT ids.id, 0.15 + 0.85 * coalesce(flow, 0) AS rank FROM ids LEFT JOIN (
    SELECT dst AS id, sum(w * rank) AS flow FROM weights JOIN r{i - 1} ON src = r{i - 1}.id GROUP BY dst
  ) m ON ids.id = m.id)""")
    parts.append(f"""ranks AS (
  SELECT id, rank * (SELECT count(*) / sum(rank) FROM r{rounds}) AS pagerank FROM r{rounds})""")
    return ",\n".join(parts)


def pagerank_until(source: str, tol: float, rounds: int) -> str:
    """As ``pagerank``, with only growing vertices sending; idle rounds at the
    end change nothing."""
    parts = [
        f"links AS MATERIALIZED (SELECT src, dst, count(*) AS copies FROM {source} GROUP BY ALL)",
        "ids AS MATERIALIZED (SELECT src AS id FROM links UNION SELECT dst FROM links)",
        "degree AS MATERIALIZED (SELECT src, sum(copies) AS d FROM links GROUP BY src)",
        "weights AS MATERIALIZED (SELECT src, dst, copies / d AS w FROM links JOIN degree USING (src))",
        "r0 AS MATERIALIZED (SELECT id, 0.15::DOUBLE AS rank, 0.15::DOUBLE AS growth FROM ids)",
    ]
    for i in range(1, rounds + 1):
        parts.append(f"""r{i} AS MATERIALIZED (
  SELECT o.id, o.rank + coalesce(0.85 * flow, 0) AS rank, coalesce(0.85 * flow, 0) AS growth
  FROM r{i - 1} o LEFT JOIN (
    SELECT dst AS id, sum(w * growth) AS flow FROM weights JOIN r{i - 1} s ON src = s.id
    WHERE growth > {tol!r} GROUP BY dst
  ) m ON o.id = m.id)""")
    parts.append(f"""ranks AS (
  SELECT id, rank * (SELECT count(*) / sum(rank) FROM r{rounds}) AS pagerank FROM r{rounds})""")
    return ",\n".join(parts)


def label_propagation(source: str, rounds: int) -> str:
    """CTEs up to ``l{rounds}(id, label)``."""
    parts = [
        f"""links AS MATERIALIZED (
  SELECT src, dst, count(*) AS n FROM (
    SELECT src, dst FROM {source} UNION ALL SELECT dst, src FROM {source}) GROUP BY ALL)""",
        "l0 AS MATERIALIZED (SELECT DISTINCT src AS id, src AS label FROM links)",
    ]
    for i in range(1, rounds + 1):
        parts.append(f"""l{i} AS MATERIALIZED (
  SELECT dst AS id, label FROM (
    SELECT dst, label, sum(n) AS votes FROM links JOIN l{i - 1} ON src = id GROUP BY dst, label)
  QUALIFY row_number() OVER (PARTITION BY dst ORDER BY votes DESC, label) = 1)""")
    return ",\n".join(parts)


def greedy(source: str, name: str, rounds: int, label: int | str | None = None) -> str:
    """CTEs for greedy rounds over ``source(src, dst, priority)``; the choices
    are ``{name}_chosen(src, dst, round)`` and what is left ``{name}_left``."""
    parts, left = [], source
    for i in range(1, rounds + 1):
        parts.append(f"""{name}_n{i} AS MATERIALIZED (
  SELECT id, arg_min(other, priority) AS other FROM (
    SELECT src AS id, dst AS other, priority FROM {left} UNION ALL
    SELECT dst, src, priority FROM {left}) GROUP BY id),
{name}_c{i} AS MATERIALIZED (
  SELECT a.id AS src, a.other AS dst, {i if label is None else label} AS round
  FROM {name}_n{i} a JOIN {name}_n{i} b ON a.other = b.id AND b.other = a.id WHERE a.id < a.other),
{residual(left, f"{name}_c{i}", f"{name}_l{i}")}""")
        left = f"{name}_l{i}"
    chosen = " UNION ALL ".join(f"SELECT * FROM {name}_c{i}" for i in range(1, rounds + 1))
    parts.append(f"{name}_chosen AS MATERIALIZED ({chosen}), {name}_left AS (SELECT * FROM {left})")
    return ",\n".join(parts)


def residual(left: str, chosen: str, name: str) -> str:
    return f"""{name} AS MATERIALIZED (
  SELECT l.* FROM {left} l
  ANTI JOIN (SELECT src AS id FROM {chosen} UNION ALL SELECT dst FROM {chosen}) a ON l.src = a.id
  ANTI JOIN (SELECT src AS id FROM {chosen} UNION ALL SELECT dst FROM {chosen}) b ON l.dst = b.id)"""


def prioritised(source: str, seed: object, name: str = "queue") -> str:
    return canonical(source) + f""",
{name} AS MATERIALIZED (SELECT src, dst, {hash60(seed, "src", "dst")} AS priority FROM pairs)"""


def params(source: str, k_rounding: str = "floor") -> str:
    return f"""params AS MATERIALIZED (
  SELECT delta, pow(delta, -0.77) AS p,
         greatest({k_rounding}(pow(delta, 0.12)), 1)::BIGINT AS k,
         ceil(ln(delta) / ln(1.1))::BIGINT AS max_rounds
  FROM (SELECT max(degree) AS delta FROM (
    SELECT count(*) AS degree FROM (
      SELECT src AS id FROM {source} UNION ALL SELECT dst FROM {source}) GROUP BY id)))"""


def sample(left: str, name: str, seed: object, number: int, only: str = "true") -> str:
    """Sampled edges of one round whose ends share a vertex part."""
    part = [f"{hash60(f'part-{seed}-{number}', side)} % (SELECT k FROM params)" for side in ("src", "dst")]
    return f"""{name} AS MATERIALIZED (
  SELECT * FROM {left}
  WHERE {uniform(f"edge-{seed}-{number}", "src", "dst")} < (SELECT p FROM params)
    AND {part[0]} = {part[1]} AND {only})"""


def mpc(source: str, seed: object, rounds: int, inner: int, sweep: int, fixed: str | None = None, measured: str | None = None) -> str:
    """CTEs up to ``matching(src, dst, round)``; ``fixed`` gives p and k, else the degrees of ``measured`` or the source do."""
    given = params(measured or source) if fixed is None else f"params AS (SELECT {fixed})"
    parts, left, chosen = [given, prioritised(source, seed)], "queue", []
    for i in range(1, rounds + 1):
        parts.append(sample(left, f"s{i}", seed, i))
        parts.append(greedy(f"s{i}", f"m{i}", inner, label=i))
        parts.append(residual(left, f"m{i}_chosen", f"rest{i}"))
        left = f"rest{i}"
        chosen.append(f"m{i}_chosen")
    if sweep:
        parts.append(greedy(left, "final", sweep, label=rounds + 1))
        chosen.append("final_chosen")
    parts.append("matching AS (" + " UNION ALL ".join(f"SELECT * FROM {c}" for c in chosen) + ")")
    return ",\n".join(parts)


#: Limits of the rounds by name, over the CTEs ``params`` and ``queue``; without one the rounds written out suffice.
LIMITS = {
    "log_delta": "(SELECT max_rounds FROM params)",
    "log_edges": "(SELECT ceil(ln(count(*))) FROM queue)",
    "log_edges_p": "(SELECT ceil(ln(count(*)) / ln(1 / (SELECT p FROM params))) FROM queue)",
    None: "1000000",
}

#: When the round after round ``i`` runs.
GOES_ON = {
    "empty": "EXISTS (SELECT 1 FROM rest{i})",
    "unchanged": "EXISTS (SELECT 1 FROM m{i}_chosen)",
    "degree_one": """coalesce((SELECT max(n) FROM (
  SELECT count(*) AS n FROM (SELECT src AS id FROM rest{i} UNION ALL SELECT dst FROM rest{i}) GROUP BY id)), 0) > 1""",
}


def mpc_until(
    source: str, seed: object, limit: str | None, stop: str, most: int, inner: int, sweep: int,
    fixed: str | None = None, k_rounding: str = "floor",
) -> str:
    """As ``mpc``, with rounds up to a limit by name or until a stop rule holds; ``most`` rounds are written out."""
    given = params(source, k_rounding) if fixed is None else f"params AS (SELECT {fixed})"
    parts, left, chosen = [given, prioritised(source, seed)], "queue", []
    for i in range(1, most + 1):
        last = f"(SELECT on_ FROM go{i - 1}) AND {GOES_ON[stop].format(i=i - 1)}" if i > 1 else "true"
        parts.append(f"go{i} AS MATERIALIZED (SELECT {i} <= {LIMITS[limit]} AND {last} AS on_)")
        parts.append(sample(left, f"s{i}", seed, i, f"(SELECT on_ FROM go{i})"))
        parts.append(greedy(f"s{i}", f"m{i}", inner, label=i))
        parts.append(residual(left, f"m{i}_chosen", f"rest{i}"))
        left = f"rest{i}"
        chosen.append(f"m{i}_chosen")
    done = " + ".join(f"(SELECT on_::INT FROM go{i})" for i in range(1, most + 1))
    parts.append(f"ended AS MATERIALIZED (SELECT ({done} + 1)::INT AS label)")
    parts.append(greedy(left, "final", sweep, label="(SELECT label FROM ended)"))
    chosen.append("final_chosen")
    parts.append("matching AS (" + " UNION ALL ".join(f"SELECT * FROM {c}" for c in chosen) + ")")
    return ",\n".join(parts)
