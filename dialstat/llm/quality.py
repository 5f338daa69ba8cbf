"""Quality rules with robust multivariate outliers (operator 6), in Spark expressions only.

Base statistics of every whole text (words ``[^\\x20\\x09-\\x0D]+``): words, code points in words,
symbols ``[#*$%&|<>]``, lines equal to an earlier line, and words in 3-word windows that stand
twice or more in the text.  A text fails at once with fewer than 50 words or if over half of its
words repeat.

The others are judged by source.  Five transformed statistics (:data:`FEATURES`) make a vector;
for each language and source the minimum covariance determinant gives a robust centre and
covariance: from two starts, concentration steps take the nearest (vectors + features + 1) / 2 by
Mahalanobis distance and estimate anew from them, with the consistency factor of the share that
they took; the start with the smaller determinant wins.  A row farther than the chi-square bound is
rejected.  Texts with equal statistics count once in a group.  So the estimates stand against junk
that fills nearly half of a group, and against copies that fill any part of it.  Every feature
has a floor, the deviation that is never held against a text; its square is added to the
variance, which also keeps a constant feature from making the covariance singular.

A step is one aggregation: vectors fall into bins of their squared distance, each bin keeps its
moments (count, sums, products), and the bins up to the wanted share are added up; so a group
with a third of all rows is summed map-side, and nothing but a few hundred rows per group is
shuffled.

An estimate needs ``LEAST_ROWS`` different vectors.  A source with fewer is judged by the estimate over
its whole language, and where the language has fewer by the one over all rows.

Windows that repeat are found by sorting hashes with their positions packed below them, then
compared as words, so a hash collision cannot count.

Defined results for odd rows: a null text has no words and fails; null languages or sources are a
group of their own; ids may be null or repeated, each input row gives one row; a table with fewer
than ``LEAST_ROWS`` different vectors in all has no estimate, and its rows that pass the base
rules are kept.  Other columns are ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dialstat.llm.staging import broadcast_within, stage

# Feature name, expression over the base statistics, floor.
FEATURES = [
    ("f_length", "ln(n_words)", 0.5),
    ("f_word", "word_chars / n_words", 0.5),
    ("f_symbols", "ln(1 + 100e0 * n_symbols / word_chars)", 0.25),
    ("f_lines", "n_dup_lines / n_lines", 0.15),
    ("f_repeat", "n_repeat_words / n_words", 0.15),
]
NAMES = [f[0] for f in FEATURES]
FLOORS = [f[2] for f in FEATURES]
STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines", "n_repeat_words")
_WORKING = ("words", "lines", "bits", "packed", "pairs", "maybe", "keyed", "starts")
STEPS = 4
LEAST_ROWS = 50
BROADCAST_GROUPS = 50_000  # rows of estimates, 200 bytes each: 10 MB; beyond, joins by shuffle
# Fixed values for five features: the bound is the chi-square quantile of 1 - 1e-9; the covariance of
# the nearest share of normal data is smaller than that of all by these factors, linear in between.
BOUND = 50.8
CONSISTENCY_OF_SHARE = [
    (0.5, 1.9122), (0.55, 1.7924), (0.6, 1.6848), (0.65, 1.5869), (0.7, 1.4965), (0.75, 1.4121),
    (0.8, 1.332), (0.85, 1.2547), (0.9, 1.1782), (0.95, 1.099), (0.99, 1.0258), (1.0, 1.0),
]
_BINS_PER_OCTAVE = 8
_PAIRS = list(itertools.combinations_with_replacement(range(len(NAMES)), 2))

_SPACE = " \t\n\x0b\f\r"
_WINDOWS = (
    "CASE WHEN size(words) >= 3 THEN "
    "transform(sequence(0, size(words) - 3), i -> (shiftleft(xxhash64(words[i], words[i + 1], words[i + 2]), bits) | i)) "
    "ELSE array() END"
)


def _covered(starts: Column) -> Column:
    """Words inside 3-word windows that begin at the sorted positions."""
    gaps = F.zip_with(
        starts,
        F.slice(starts, F.lit(2), F.size(starts)),
        lambda a, b: F.coalesce(F.least(F.lit(3), b - a), F.lit(3)),
    )
    return F.aggregate(gaps, F.lit(0).cast("long"), lambda n, g: n + g)


def _neighbours(sorted_items: Column, same) -> Column:
    """The items of a sorted array that are the same as the one before or after."""
    n = F.size(sorted_items)
    before = F.concat(F.array(F.lit(None)), F.slice(sorted_items, F.lit(1), F.greatest(n - 1, F.lit(0))))
    after = F.slice(sorted_items, F.lit(2), n)
    marked = F.zip_with(
        F.zip_with(sorted_items, before, lambda x, b: F.struct(x.alias("x"), F.coalesce(same(x, b), F.lit(False)).alias("m"))),
        after,
        lambda s, a: F.when(s["m"] | F.coalesce(same(s["x"], a), F.lit(False)), s["x"]),
    )
    return F.filter(marked, lambda x: x.isNotNull())


def text_statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` without its text, with :data:`STATISTICS` (all long); columns of ``docs`` that have
    the name of a statistic or of a working column are left out."""
    others = [c for c in docs.columns if c not in (text_col, *STATISTICS, *_WORKING)]
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    split = docs.select(
        *others,
        F.filter(F.split(text, r"[\x20\x09-\x0D]+", -1), lambda w: w != "").alias("words"),
        lines.alias("lines"),
        (F.octet_length(text) - F.octet_length(F.regexp_replace(text, r"[#*$%&|<>]", ""))).cast("long").alias("n_symbols"),
    )
    counted = split.select(
        *others,
        "words",
        F.size("words").cast("long").alias("n_words"),
        F.char_length(F.array_join("words", "")).cast("long").alias("word_chars"),
        "n_symbols",
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        # bits that hold any position of the text
        F.ceil(F.log2(F.size("words") + 1)).cast("int").alias("bits"),
    )
    kept = [c for c in counted.columns if c not in ("words", "bits")]
    hashed = counted.select(*kept, "words", "bits", F.sort_array(F.expr(_WINDOWS)).alias("packed"))
    # positions of windows whose hash is a neighbour's: few texts have any
    n = F.size("packed")
    pairs = F.zip_with(
        F.slice("packed", F.lit(1), F.greatest(n - 1, F.lit(0))),
        F.slice("packed", F.lit(2), n),
        lambda a, b: F.when(F.call_function("shiftright", a.bitwiseXOR(b), F.col("bits")) == 0, F.array(a, b)),
    )
    low = lambda x: x.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bits")) - 1).cast("int")
    maybe = hashed.select(*kept, "words", F.filter(pairs, lambda p: p.isNotNull()).alias("pairs"), "bits").select(
        *kept, "words", F.when(F.size("pairs") > 0, F.array_distinct(F.transform(F.flatten("pairs"), low))).alias("maybe")
    )
    word = lambda i: F.get(F.col("words"), i)
    keyed = maybe.select(
        *kept,
        F.when(
            F.col("maybe").isNotNull(),
            F.sort_array(
                F.transform(
                    "maybe",
                    lambda i: F.struct(F.concat_ws(" ", word(i), word(i + 1), word(i + 2)).alias("window"), i.alias("at")),
                )
            ),
        ).alias("keyed"),
    )
    sure = keyed.select(
        *kept,
        F.when(
            F.col("keyed").isNotNull(),
            F.sort_array(F.transform(_neighbours(F.col("keyed"), lambda a, b: a["window"] == b["window"]), lambda k: k["at"])),
        ).alias("starts"),
    )
    return sure.select(*kept, F.coalesce(_covered(F.col("starts")), F.lit(0)).cast("long").alias("n_repeat_words"))


def _moments() -> list[Column]:
    """Count, sums and products of the features."""
    out = [F.count("*").alias("n")]
    out += [F.sum(a).alias(f"s{i}") for i, a in enumerate(NAMES)]
    out += [F.sum(F.col(NAMES[i]) * F.col(NAMES[j])).alias(f"p{i}{j}") for i, j in _PAIRS]
    return out


def _distance() -> Column:
    """Squared Mahalanobis distance: the squared length of W (x - m), W lower triangular."""
    p = len(NAMES)
    away = [F.col(a) - F.col(f"m{i}") for i, a in enumerate(NAMES)]
    rows = [sum((F.col(f"w{i}{j}") * away[j] for j in range(i + 1)), F.lit(0.0)) for i in range(p)]
    return sum((r * r for r in rows), F.lit(0.0))


def _consistency() -> str:
    """The consistency factor for ``n`` vectors taken of ``whole``, as SQL."""
    share = f"greatest(CAST(n AS DOUBLE) / whole, {CONSISTENCY_OF_SHARE[0][0]}e0)"
    lines = [
        f"WHEN {share} < {b}e0 THEN {at_a}e0 + ({share} - {a}e0) * ({(at_b - at_a) / (b - a)!r})"
        for (a, at_a), (b, at_b) in itertools.pairwise(CONSISTENCY_OF_SHARE)
    ]
    return f"CASE {' '.join(lines)} ELSE {CONSISTENCY_OF_SHARE[-1][1]}e0 END"


def _factor_layers() -> list[dict[str, str]]:
    """Centre m, covariance c, its Cholesky factor l and the factor's inverse w from the columns n,
    whole, s and p, as SQL expressions; each layer refers to those before it."""
    p = len(NAMES)
    layers = [{"consistency": _consistency(), **{f"m{i}": f"s{i} / n" for i in range(p)}}]
    layers.append(
        {
            f"c{j}{i}": f"consistency * (p{i}{j} / n - m{i} * m{j})" + (f" + {FLOORS[i] ** 2}" if i == j else "")
            for i, j in _PAIRS
        }
    )
    for j in range(p):  # c = l l'
        minus = "".join(f" - l{j}{k} * l{j}{k}" for k in range(j))
        layers.append({f"l{j}{j}": f"sqrt(greatest(c{j}{j}{minus}, 1e-12))"})
        below = {
            f"l{i}{j}": f"(c{i}{j}" + "".join(f" - l{i}{k} * l{j}{k}" for k in range(j)) + f") / l{j}{j}"
            for i in range(j + 1, p)
        }
        layers += [below] if below else []
    for i in range(p):
        layers.append({f"w{i}{i}": f"1 / l{i}{i}"})
        row = {f"w{i}{j}": "-(" + " + ".join(f"l{i}{k} * w{k}{j}" for k in range(j, i)) + f") / l{i}{i}" for j in range(i)}
        layers += [row] if row else []
    layers.append({"log_det": " + ".join(f"2 * ln(l{i}{i})" for i in range(p))})
    return layers


_ESTIMATE = [f"m{i}" for i in range(len(NAMES))] + [f"w{i}{j}" for i in range(len(NAMES)) for j in range(i + 1)] + ["log_det"]


def _factored(covariances: DataFrame, keys: list[str]) -> DataFrame:
    """The estimate (centre, inverse Cholesky factor, log determinant) of each row's moments."""
    df = covariances
    for layer in _factor_layers():
        df = df.withColumns({name: F.expr(e) for name, e in layer.items()})
    return df.select(*keys, *_ESTIMATE)


def _start_medians(rows: DataFrame) -> DataFrame:
    """A start from each feature alone: the median, and floor-wide axes.

    Medians come from counts of bins a quarter of a floor wide.
    """
    p = len(NAMES)
    bins = rows.select(
        "grp",
        F.posexplode(F.array(*[F.floor(F.col(a) / (f / 4)).cast("long") for a, f in zip(NAMES, FLOORS)])).alias("feature", "bin"),
    )
    counts = bins.groupBy("grp", "feature", "bin").agg(F.count("*").alias("n"))
    ranked = counts.selectExpr(
        "grp",
        "feature",
        "bin",
        "sum(n) OVER (PARTITION BY grp, feature ORDER BY bin) AS upto",
        "sum(n) OVER (PARTITION BY grp, feature) AS whole",
    )
    middle = ranked.filter("2 * upto >= whole").groupBy("grp", "feature").agg(F.min("bin").alias("bin"))
    medians = middle.groupBy("grp").agg(
        *[F.max(F.when(F.col("feature") == i, (F.col("bin") + 0.5) * (FLOORS[i] / 4))).alias(f"m{i}") for i in range(p)]
    )
    axes = [F.lit(1 / FLOORS[i] if i == j else 0.0).alias(f"w{i}{j}") for i in range(p) for j in range(i + 1)]
    return medians.select("grp", F.lit(0).alias("start"), *[f"m{i}" for i in range(p)], *axes, F.lit(0.0).alias("log_det"))


def _concentrate(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    """One concentration step for every (group, start): estimates from the nearest half of its
    vectors."""
    near = rows.join(broadcast_within(estimates, BROADCAST_GROUPS), "grp").withColumn(
        "bin", F.floor(F.log2(_distance() + 1e-6) * _BINS_PER_OCTAVE).cast("long")
    )
    binned = near.groupBy("grp", "start", "bin").agg(*_moments())
    ranked = binned.withColumns(
        {
            "before": F.expr("sum(n) OVER (PARTITION BY grp, start ORDER BY bin) - n"),
            "whole": F.expr("sum(n) OVER (PARTITION BY grp, start)"),
        }
    )
    names = ["n", *[f"s{i}" for i in range(len(NAMES))], *[f"p{i}{j}" for i, j in _PAIRS]]
    wanted = (F.col("whole") + len(NAMES) + 1) / 2
    chosen = ranked.filter(F.col("before") < wanted).groupBy("grp", "start").agg(
        *[F.sum(c).alias(c) for c in names], F.max("whole").alias("whole")
    )
    return _factored(chosen, ["grp", "start"])


def robust_estimates(rows: DataFrame) -> DataFrame:
    """Centre and inverse factor of every group ``grp`` of feature rows."""
    whole = rows.groupBy("grp").agg(*_moments()).withColumns({"start": F.lit(1), "whole": F.col("n")})
    estimates = _start_medians(rows).unionByName(_factored(whole, ["grp", "start"]))
    estimates = stage(estimates, "estimates")
    for _ in range(STEPS):
        estimates = stage(_concentrate(rows, estimates), "estimates")
    best = estimates.groupBy("grp").agg(F.min(F.struct("log_det", "start")).alias("best"))
    return estimates.join(best, "grp").filter("start = best.start").drop("best", "start", "log_det")


def _judging_groups(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Different vectors of every (own_group, language) -> (the vectors of every group that judges
    somebody, the group that judges each own_group)."""
    enough = F.col("count") >= LEAST_ROWS
    own = stage(vectors.groupBy("own_group", "language").count(), "group_sizes")
    small = own.filter(~enough).select("language").distinct()
    of_language = vectors.join(broadcast_within(small, BROADCAST_GROUPS), "language").select("language", *STATISTICS).distinct()
    languages = of_language.groupBy("language").agg(F.count("*").alias("speakers"))
    judged_by = own.join(languages, "language", "left").withColumn(
        "grp",
        F.when(enough, F.concat(F.lit("own "), "own_group"))
        .when(F.col("speakers") >= LEAST_ROWS, F.concat(F.lit("language "), "language"))
        .otherwise(F.lit("all")),
    )
    judged_by = stage(judged_by.select("own_group", "grp"), "judged_by")
    used = judged_by.select("grp").distinct()
    members = vectors.select(F.concat(F.lit("own "), "own_group").alias("grp"), *STATISTICS)
    members = members.union(of_language.select(F.concat(F.lit("language "), "language"), *STATISTICS))
    if not judged_by.filter("grp = 'all'").isEmpty():
        members = members.union(vectors.select(F.lit("all"), *STATISTICS).distinct())
    rows = members.join(broadcast_within(used, BROADCAST_GROUPS), "grp", "left_semi")
    return stage(rows.select("grp", *[F.expr(e).alias(name) for name, e, _ in FEATURES]), "vectors"), judged_by


def judge_quality(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    least_words: int = 50,
    bound: float = BOUND,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Base statistics, squared distance (null for texts that fail) and verdict of every row.

    :param carry: columns of ``docs`` that stay in the result, as carried_0, ...; the text may be one.
        Then statistics are computed again where the rows are judged, and no text is written.
    """
    part = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-"))
    carried = [F.col(c).alias(f"carried_{i}") for i, c in enumerate(carry)]
    read = [
        F.col(id_col).alias("doc_id"),
        F.col(text_col).alias("text"),
        F.to_json(F.array(part(lang_col), part(source_col))).alias("own_group"),
        part(lang_col).alias("language"),
    ]
    base = (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    passed = ~F.col("base_failed")
    stats = text_statistics(docs.select(*read)).withColumn("base_failed", base)
    stats = stage(stats, "quality")
    vectors = stage(stats.filter(passed).select("own_group", "language", *STATISTICS).distinct(), "different")
    rows, judged_by = _judging_groups(vectors)
    estimates = stage(robust_estimates(rows), "robust")
    whole = rows.groupBy("grp").count().filter(F.col("count") >= LEAST_ROWS).select("grp")
    trusted = judged_by.join(estimates.join(whole, "grp", "left_semi"), "grp")
    trusted = stage(trusted.drop("grp"), "trusted")
    if carry:
        # A column that no optimiser moves a filter below, or the verdict's filter would be written out in
        # terms of the text, many times over.
        again = text_statistics(docs.select(*read, *carried)).withColumn("fence", F.monotonically_increasing_id())
        stats = again.withColumn("base_failed", base)
        passed = passed & (F.col("fence") >= 0)
    stats = stats.withColumns({name: F.when(passed, F.expr(e)) for name, e, _ in FEATURES})
    judged = stats.join(broadcast_within(trusted, BROADCAST_GROUPS), "own_group", "left").withColumn("distance", _distance())
    return judged.select(
        F.col("doc_id").alias(id_col),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        F.when(passed, F.col("distance")).alias("distance"),
        (passed & F.coalesce(F.col("distance") <= bound, F.lit(True))).alias("kept"),
        *[F.col(f"carried_{i}") for i in range(len(carried))],
    )


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base statistics and verdict of every document."""
    return judge_quality(spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")).drop("distance")


def _op6_sql() -> str:
    """The query in DuckDB SQL; every step a table of its own, as in Spark."""
    p = len(NAMES)
    moments = ", ".join(
        ["count(*) AS n", *(f"sum({a}) AS s{i}" for i, a in enumerate(NAMES)), *(f"sum({NAMES[i]} * {NAMES[j]}) AS p{i}{j}" for i, j in _PAIRS)]
    )
    sums = ", ".join(f"sum({c}) AS {c}" for c in ["n", *(f"s{i}" for i in range(p)), *(f"p{i}{j}" for i, j in _PAIRS)])

    def factored(table: str) -> str:
        for layer in _factor_layers():
            table = f"(SELECT *, {', '.join(f'{e} AS {name}' for name, e in layer.items())} FROM {table})"
        return table

    kept = ", ".join(_ESTIMATE)
    rows = [" + ".join(f"w{i}{j} * ({NAMES[j]} - m{j})" for j in range(i + 1)) for i in range(p)]
    distance = " + ".join(f"({r}) * ({r})" for r in rows)
    space = r"[\x20\x09-\x0D]"
    starts = ", ".join(
        [f"max(CASE WHEN feature = {i} THEN (bin + 0.5) * {FLOORS[i] / 4} END) AS m{i}" for i in range(p)]
        + [f"{1 / FLOORS[i] if i == j else 0.0}e0 AS w{i}{j}" for i in range(p) for j in range(i + 1)]
    )
    features = " UNION ALL ".join(f"SELECT grp, {i} AS feature, floor({a} / {f / 4}) AS bin FROM r" for i, (a, f) in enumerate(zip(NAMES, FLOORS)))
    steps, last = [], "e0"
    for k in range(1, STEPS + 1):
        steps.append(f"""
b{k} AS MATERIALIZED (SELECT grp, start, floor(log2({distance} + 1e-6) * {_BINS_PER_OCTAVE}) AS bin, {moments}
  FROM r JOIN {last} USING (grp) GROUP BY ALL),
c{k} AS MATERIALIZED (SELECT grp, start, {sums}, max(whole) AS whole FROM (
    SELECT *, sum(n) OVER (PARTITION BY grp, start ORDER BY bin) - n AS before, sum(n) OVER (PARTITION BY grp, start) AS whole FROM b{k})
  WHERE before < (whole + {p} + 1) / 2e0 GROUP BY grp, start),
e{k} AS MATERIALIZED (SELECT grp, start, {kept} FROM {factored(f"c{k}")}),""")
        last = f"e{k}"
    return f"""
WITH t AS (SELECT row_number() OVER () AS id, doc_id, lang, source, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT *, list_filter(regexp_split_to_array(text, '{space}+'), lambda x: x <> '') AS words,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM t),
win AS (
  SELECT id, unnest(range(1, len(words) - 1)) AS i,
         unnest(list_transform(range(1, len(words) - 1), lambda i: array_to_string(words[i:i + 2], ' '))) AS g
  FROM w WHERE len(words) >= 3),
rep AS (
  SELECT id, count(DISTINCT pos) AS n_repeat_words
  FROM (SELECT id, unnest([i, i + 1, i + 2]) AS pos FROM (SELECT *, count(*) OVER (PARTITION BY id, g) AS k FROM win) WHERE k > 1)
  GROUP BY id),
st AS MATERIALIZED (
  SELECT doc_id, lang, source, CAST(len(words) AS BIGINT) AS n_words,
         CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
         CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, len(lines) AS n_lines,
         CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
  FROM w LEFT JOIN rep USING (id)),
f AS MATERIALIZED (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM st),
v AS MATERIALIZED (SELECT DISTINCT lang, source, {", ".join(STATISTICS)} FROM f WHERE NOT base_failed),
lv AS MATERIALIZED (SELECT DISTINCT lang, {", ".join(STATISTICS)} FROM v),
av AS (SELECT DISTINCT {", ".join(STATISTICS)} FROM v),
sizes AS (SELECT lang, source, count(*) AS own FROM v GROUP BY ALL),
speakers AS (SELECT lang, count(*) AS many FROM lv GROUP BY ALL),
judge AS MATERIALIZED (
  SELECT s.lang, s.source, CASE WHEN own >= {LEAST_ROWS} THEN ['own', s.lang, s.source]
    WHEN many >= {LEAST_ROWS} THEN ['language', s.lang] ELSE ['all'] END AS grp
  FROM sizes s JOIN speakers l ON l.lang IS NOT DISTINCT FROM s.lang),
g AS MATERIALIZED (
  SELECT f.*, judge.grp FROM f LEFT JOIN judge ON judge.lang IS NOT DISTINCT FROM f.lang AND judge.source IS NOT DISTINCT FROM f.source),
r AS MATERIALIZED (
  SELECT grp, {", ".join(f"{e} AS {name}" for name, e, _ in FEATURES)}
  FROM (SELECT ['own', lang, source] AS grp, * EXCLUDE (lang, source) FROM v UNION ALL SELECT ['language', lang], * EXCLUDE (lang) FROM lv
        UNION ALL SELECT ['all'], * FROM av) WHERE grp IN (SELECT grp FROM judge)),
bins AS (SELECT grp, feature, bin, count(*) AS n FROM ({features}) GROUP BY ALL),
mid AS (SELECT grp, feature, min(bin) AS bin FROM (
  SELECT *, sum(n) OVER (PARTITION BY grp, feature ORDER BY bin) AS upto, sum(n) OVER (PARTITION BY grp, feature) AS whole FROM bins)
  WHERE 2 * upto >= whole GROUP BY grp, feature),
e0 AS MATERIALIZED (
  SELECT grp, 0 AS start, {starts}, 0e0 AS log_det FROM mid GROUP BY grp
  UNION ALL
  SELECT grp, 1 AS start, {kept} FROM {factored(f"(SELECT *, n AS whole FROM (SELECT grp, {moments} FROM r GROUP BY grp))")}),
{"".join(steps)}
best AS (
  SELECT * FROM {last} WHERE grp IN (SELECT grp FROM r GROUP BY grp HAVING count(*) >= {LEAST_ROWS})
  QUALIFY row_number() OVER (PARTITION BY grp ORDER BY log_det, start) = 1)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND coalesce(d <= {BOUND}, TRUE) AS kept
FROM (
  SELECT g.*, CASE WHEN NOT base_failed THEN {distance} END AS d
  FROM (SELECT *, {", ".join(f"CASE WHEN NOT base_failed THEN {e} END AS {name}" for name, e, _ in FEATURES)} FROM g) g
  LEFT JOIN best USING (grp)) g
"""


OP6_SQL = _op6_sql()
