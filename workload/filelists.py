"""Queries over detector file lists."""

from __future__ import annotations

from pyspark.sql import functions as F

from clickloom.functions import filenames as N
from clickloom.operators import files as P
from workload import fixtures as X
from workload.fixtures import with_views
from workload.registry import query

PARSED = """
SELECT *, concat_ws('_', date_str, serial, file_no) AS base_key, concat_ws('_', date_str, serial, file_no, family, kind) AS pair_key,
       concat_ws('_', date_str, serial, file_no, family) AS pair_group_key,
       concat_ws('_', regexp_replace(name_ext, '(?i)\\.(CP|FP)[13]$', ''), family) AS pair_variant_key,
       3 * CAST(regexp_matches(core, 'POD[0-9]+\\s+[A-Za-z]+[A-Za-z0-9]*\\s+file') AS INT)
       + 3 * CAST(len(regexp_extract_all(core, 'POD[0-9]+')) > 1 AS INT)
       + 2 * CAST(has_part AS INT) + 2 * CAST(has_soft AS INT) + 5 * CAST(file_no = 'NA' AS INT) AS name_score
FROM (SELECT *,
             CASE WHEN y <> '' THEN y || lpad(m, 2, '0') || lpad(d, 2, '0') ELSE 'UNKNOWNDATE' END AS date_str,
             CASE WHEN s <> '' THEN s ELSE 'UNKNOWN' END AS serial,
             CASE WHEN f = '' THEN 'NA' ELSE lpad(CAST(CAST(f AS INT) AS VARCHAR), CAST(greatest(2, len(CAST(CAST(f AS INT) AS VARCHAR))) AS INT), '0') END AS file_no,
             CASE WHEN ext LIKE 'CP%' THEN 'CP' WHEN ext LIKE 'FP%' THEN 'FP' ELSE '' END AS family,
             regexp_replace(ext, '^[A-Z]+', '') AS kind,
             regexp_matches(core, '(?i)\\s+PART.*$') AS has_part,
             regexp_matches(core, '(?i)(^|[_\\s-])(FPODsoftware|CPODsoftware)\\b') AS has_soft
      FROM (SELECT *, regexp_extract(core, '(?:^|[^0-9])([0-9]{4})[^0-9]+(0?[1-9]|1[0-2])[^0-9]+(0?[1-9]|[12][0-9]|3[01])(?:[^0-9]|$)', 1) AS y,
                   regexp_extract(core, '(?:^|[^0-9])([0-9]{4})[^0-9]+(0?[1-9]|1[0-2])[^0-9]+(0?[1-9]|[12][0-9]|3[01])(?:[^0-9]|$)', 2) AS m,
                   regexp_extract(core, '(?:^|[^0-9])([0-9]{4})[^0-9]+(0?[1-9]|1[0-2])[^0-9]+(0?[1-9]|[12][0-9]|3[01])(?:[^0-9]|$)', 3) AS d,
                   regexp_extract(core, '(?i)(?:F?C?POD)[_\\s]*([0-9]+)', 1) AS s,
                   regexp_extract(core, '(?i)file\\s*([0-9]+)', 1) AS f
            FROM (SELECT *, upper(regexp_extract(whole, '\\.([^.]*)$', 1)) AS ext, regexp_replace(whole, '\\.[^.]+$', '') AS core
                  FROM (SELECT *, regexp_replace(name_ext, '(?i)(?:\\.(?:CP|FP)[13])+(\\.(?:CP|FP)[13]\\b)', '\\1') AS whole FROM {source}) a) b) c) p"""

SINGLE = """
SELECT *, upper(substr(e, 1, 2)) AS family, substr(e, 3, 1) AS kind
FROM (SELECT *, regexp_replace(name_ext, '\\.[^.]+$', '') AS stem, upper(regexp_extract(name_ext, '\\.([^.]*)$', 1)) AS e FROM {source}) s
WHERE NOT regexp_matches(stem, '(?i)\\.(CP|FP)[13]$')"""
STEMS = "SELECT stem, family, bool_or(kind = '1') AS h1, bool_or(kind = '3') AS h3 FROM single GROUP BY stem, family"
COPIES = "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lower(name_ext), bytes ORDER BY sel_no) AS rn FROM fx_odd_files) c WHERE rn = 1"

ODD = {"single": SINGLE.replace("{source}", "fx_odd_files"), "stems": STEMS}
DEDUP = {
    "firsts": COPIES,
    "single": SINGLE.replace("{source}", "firsts"),
    "stems": STEMS,
    "pairs": "SELECT s.sel_no, s.path, s.name_ext, s.bytes FROM single s JOIN stems t USING (stem, family) WHERE t.h1 AND t.h3",
    "parsed": PARSED.replace("{source}", "pairs"),
    "variants": """
SELECT pair_variant_key, pair_group_key, count(*) AS n, bool_or(kind = '1') AND bool_or(kind = '3') AS has_kinds,
       CAST(sum(name_score) AS BIGINT) AS sum_score, CAST(sum(bytes) AS BIGINT) AS sum_bytes, min(name_score) AS min_score,
       arg_min(name_ext, sel_no) AS first_name
FROM parsed GROUP BY pair_variant_key, pair_group_key""",
    "best": """
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY pair_group_key ORDER BY sum_score, sum_bytes DESC, min_score, first_name, pair_variant_key) AS rn
               FROM variants WHERE has_kinds AND n >= 2) v WHERE rn = 1""",
}


def parsed_odd(spark, sf):
    return P.with_name_fields(X.odd_file_list(spark, sf))


def _fields(*names: str) -> str:
    return with_views(f"SELECT sel_no, {', '.join(names)} FROM parsed", "fx_odd_files", extra={"parsed": PARSED.replace("{source}", "fx_odd_files")})


@query("f1_parse_file_name", _fields("date_str", "serial", "file_no", "family", "kind"))
def f1(spark, sf):
    return parsed_odd(spark, sf).select("sel_no", "date_str", "serial", "file_no", "family", "kind")


@query("f2_file_name_flags", _fields("CAST(has_part AS INT) AS has_part", "CAST(has_soft AS INT) AS has_soft"))
def f2(spark, sf):
    return parsed_odd(spark, sf).select("sel_no", F.col("has_part").cast("int"), F.col("has_soft").cast("int"))


@query("f3_name_score", _fields("name_score"))
def f3(spark, sf):
    return parsed_odd(spark, sf).select("sel_no", "name_score")


@query("f4_file_keys", _fields("base_key", "pair_key", "pair_group_key", "pair_variant_key"))
def f4(spark, sf):
    return parsed_odd(spark, sf).select("sel_no", "base_key", "pair_key", "pair_group_key", "pair_variant_key")


@query(
    "p9_train_files",
    with_views("SELECT sel_no, name_ext FROM fx_odd_files WHERE regexp_matches(lower(name_ext), '\\.[cf]p3$')", "fx_odd_files"),
)
def p9(spark, sf):
    return X.odd_file_list(spark, sf).filter(N.is_train_file(F.col("name_ext"))).select("sel_no", "name_ext")


@query(
    "v7_unsupported_extension",
    with_views(
        """SELECT sel_no, path, 'Unsupported file type: .' || e || '. Supported types: .CP1, .CP3, .FP1, .FP3.' AS message
FROM (SELECT *, upper(regexp_extract(name_ext, '\\.([^.]*)$', 1)) AS e FROM fx_odd_files) f WHERE e NOT IN ('CP1', 'CP3', 'FP1', 'FP3')""",
        "fx_odd_files",
    ),
)
def v7(spark, sf):
    return P.unsupported(X.odd_file_list(spark, sf)).select("sel_no", "path", "message")


@query(
    "v8_double_extension",
    with_views("SELECT sel_no, path FROM fx_odd_files WHERE regexp_matches(name_ext, '(?i)\\.(CP|FP)[13]\\.[^.]+$')", "fx_odd_files"),
)
def v8(spark, sf):
    return P.double_extensions(X.odd_file_list(spark, sf)).select("sel_no", "path")


PROBLEMS = """
SELECT path, arg_min(problem, place::BIGINT * 1000000000 + sel_no) AS problem, min(place::BIGINT * 1000000000 + sel_no) // 1000000000 AS place
FROM (SELECT path, 'DOUBLE_EXTENSION' AS problem, 0 AS place, sel_no FROM fx_odd_files WHERE regexp_matches(name_ext, '(?i)\\.(CP|FP)[13]\\.[^.]+$')
      UNION ALL
      SELECT path, 'NO_PARTNER', (CASE kind WHEN '1' THEN 1 ELSE 3 END) + CAST(family = 'FP' AS INT), sel_no
      FROM single JOIN stems USING (stem, family) WHERE h1 <> h3) p
GROUP BY path"""


@query("v9_files_without_partner", with_views(PROBLEMS, "fx_odd_files", extra=ODD))
def v9(spark, sf):
    return P.pair_problems(X.odd_file_list(spark, sf)).select("path", "problem", "place")


@query(
    "c6_pair_check_message",
    with_views(
        """SELECT n = 0 AS is_valid, CASE WHEN n = 0 THEN '' ELSE
  printf('Found %d problematic file(s): %d with multiple CP/FP tokens in the filename, %d lacking a matching pair (.CP1/.CP3 or .FP1/.FP3).', n, nd, n - nd)
  || chr(10) || 'See the ''missing'' list for full paths.' END AS message
FROM (SELECT count(*) AS n, count(*) FILTER (problem = 'DOUBLE_EXTENSION') AS nd FROM problems) c""",
        "fx_odd_files",
        extra={**ODD, "problems": PROBLEMS},
    ),
)
def c6(spark, sf):
    _, _, message = P.pair_check(X.odd_file_list(spark, sf))
    return message


@query("u2_paired_stems", with_views("SELECT stem, family FROM stems WHERE h1 AND h3", "fx_odd_files", extra=ODD))
def u2(spark, sf):
    return P.paired_stems(X.odd_file_list(spark, sf))


@query(
    "u3_lone_stems",
    with_views(
        "(SELECT stem, family FROM single WHERE kind = '3' EXCEPT SELECT stem, family FROM single WHERE kind = '1')", "fx_odd_files", extra=ODD
    ),
)
def u3(spark, sf):
    return P.lone_stems(X.odd_file_list(spark, sf), "3")


@query(
    "u4_distinct_in_order",
    with_views(
        "SELECT lower(name_ext) AS lower_name, min(sel_no) AS sel_no FROM fx_odd_files GROUP BY lower(name_ext)", "fx_odd_files"
    ),
)
def u4(spark, sf):
    """Distinct names that keep the place of their first appearance."""
    names = X.odd_file_list(spark, sf).select(F.lower("name_ext").alias("lower_name"), "sel_no")
    return P.first_row(["lower_name"], [F.col("sel_no")], names)


@query("w11_drop_copies", with_views(f"SELECT sel_no, name_ext, bytes FROM ({COPIES}) k", "fx_odd_files"))
def w11(spark, sf):
    return P.drop_copies(X.odd_file_list(spark, sf)).select("sel_no", "name_ext", "bytes")


@query("j8_keep_paired", with_views("SELECT sel_no, name_ext FROM pairs", "fx_odd_files", extra={k: DEDUP[k] for k in ("firsts", "single", "stems", "pairs")}))
def j8(spark, sf):
    return P.paired(P.drop_copies(X.odd_file_list(spark, sf))).select("sel_no", "name_ext")


def paired_odd(spark, sf):
    return P.paired(P.drop_copies(X.odd_file_list(spark, sf)))


@query("g8_variant_metrics", with_views("SELECT * FROM variants", "fx_odd_files", extra={k: v for k, v in DEDUP.items() if k != "best"}))
def g8(spark, sf):
    return P.variants(P.with_name_fields(paired_odd(spark, sf)))


@query(
    "w10_best_variant",
    with_views("SELECT pair_group_key, pair_variant_key AS best_variant_key, sum_score AS best_sum_score, sum_bytes AS best_sum_bytes FROM best", "fx_odd_files", extra=DEDUP),
)
def w10(spark, sf):
    metrics = P.variants(P.with_name_fields(paired_odd(spark, sf)))
    return P.best_variants(metrics).select("pair_group_key", "best_variant_key", "best_sum_score", "best_sum_bytes")


KEPT = """
SELECT p.sel_no, p.name_ext, p.pair_group_key, p.kind, p.name_score, p.bytes FROM parsed p JOIN best b USING (pair_variant_key)
WHERE p.kind IN ('1', '3')"""


@query("o1_kept_files_in_order", with_views(KEPT + " ORDER BY p.pair_group_key, p.kind, p.name_score, p.bytes DESC, p.sel_no", "fx_odd_files", extra=DEDUP))
def o1(spark, sf):
    kept, _ = P.dedup_files(X.odd_file_list(spark, sf))
    return kept.orderBy(*P.kept_order()).select("sel_no", "name_ext", "pair_group_key", "kind", "name_score", "bytes")


@query("c5_dedup_kept", with_views(KEPT, "fx_odd_files", extra=DEDUP))
def c5_kept(spark, sf):
    kept, _ = P.dedup_files(X.odd_file_list(spark, sf))
    return kept.select("sel_no", "name_ext", "pair_group_key", "kind", "name_score", "bytes")


REJECTED = """
SELECT p.path, p.name_ext, p.family, p.kind, p.pair_group_key, p.pair_variant_key, p.name_score, p.bytes,
       v.n AS variant_n, v.has_kinds AS variant_has_kinds, v.sum_score AS variant_sum_score, v.sum_bytes AS variant_sum_bytes, v.min_score AS variant_min_score,
       regexp_replace(b.pair_variant_key, '(?i)_(CP|FP)$', '') AS best_variant_name,
       b.sum_score AS best_sum_score, b.sum_bytes AS best_sum_bytes, b.min_score AS best_min_score,
       CASE WHEN p.kind NOT IN ('1', '3') THEN 'INVALID_EXTKIND' WHEN NOT v.has_kinds OR v.n < 2 THEN 'NOT_PAIR_13' ELSE 'WORSE_VARIANT' END AS reason,
       CASE WHEN p.kind NOT IN ('1', '3') THEN 'Extension kind not recognized as ''1'' or ''3''.'
            WHEN NOT v.has_kinds OR v.n < 2 THEN printf('Variant lacks both kinds (N=%d, HasKinds=%d).', v.n, CAST(v.has_kinds AS INT))
            ELSE format('Dedup by pair: this variant SumScore={:g}, SumBytes={:g}, MinScore={:g}; best variant "{}" SumScore={:g}, SumBytes={:g}, MinScore={:g}.',
                        v.sum_score::DOUBLE, v.sum_bytes::DOUBLE, v.min_score::DOUBLE, regexp_replace(b.pair_variant_key, '(?i)_(CP|FP)$', ''),
                        b.sum_score::DOUBLE, b.sum_bytes::DOUBLE, b.min_score::DOUBLE) END AS reason_detail
FROM parsed p LEFT JOIN variants v ON v.pair_variant_key = p.pair_variant_key AND v.pair_group_key = p.pair_group_key
LEFT JOIN best b ON b.pair_group_key = p.pair_group_key
WHERE NOT coalesce(b.pair_variant_key = p.pair_variant_key AND p.kind IN ('1', '3'), FALSE)"""


@query("c5_dedup_rejected", with_views(REJECTED, "fx_odd_files", extra=DEDUP), gaps=("best_sum_score", "best_sum_bytes", "best_min_score",))
def c5_rejected(spark, sf):
    _, rejected = P.dedup_files(X.odd_file_list(spark, sf))
    return rejected


UNPAIRED = {k: v.replace("FROM pairs)", "FROM fx_odd_files)") for k, v in DEDUP.items() if k not in ("firsts", "single", "stems", "pairs")}


@query("f5_reject_reason", with_views(f"SELECT path, reason, reason_detail FROM ({REJECTED}) r", "fx_odd_files", extra=UNPAIRED))
def f5(spark, sf):
    """Reasons over a list that was not pair-checked, so that every code occurs."""
    _, rejected = P.best_files(X.odd_file_list(spark, sf))
    return rejected.select("path", "reason", "reason_detail")


@query(
    "j7_metrics_on_rejected",
    with_views(f"SELECT path, variant_n, variant_sum_bytes, best_variant_name, best_sum_bytes FROM ({REJECTED}) r", "fx_odd_files", extra=UNPAIRED),
    gaps=("best_sum_bytes",),
)
def j7(spark, sf):
    _, rejected = P.best_files(X.odd_file_list(spark, sf))
    return rejected.select("path", "variant_n", "variant_sum_bytes", "best_variant_name", "best_sum_bytes")
