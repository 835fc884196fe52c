"""Quality rules: text statistics and robust multivariate outliers.

Per (lang, source) the minimum covariance determinant is estimated: of the statistic vectors, the
half whose covariance is smallest give centre and covariance; the rows near it by a chi-square bound
give the final ones. A document whose Mahalanobis distance from these is beyond a cutoff is rejected.

Rows: one per row of `docs`. A null text has no words and fails the base rule. Null lang or source
is a value of its own. Groups with few rows are judged by an estimate of all rows of their language,
or of all documents where the language has few as well.
Ties at the edge of the half all count. Repeated rows count as often as they occur.
"""

from __future__ import annotations


import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dqtable.llm.common import fill, pieces, stored, with_columns, work_folder

SYMBOLS = b"#*$%&|<>"
_CONTINUED = bytes(range(0x80, 0xC0))  # bytes that continue a code point
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Transformed statistics are whole multiples of 1/SCALE, so that sums of them are exact.
SCALE = 1024
LIMIT = 16 * SCALE
#: Smallest spread assumed per transformed statistic: many groups are constant in some of them.
FEATURES = {"f_length": 0.5, "f_word": 0.1, "f_symbols": 0.5, "f_lines": 0.1, "f_repeats": 0.1}
NAMES = tuple(FEATURES)
PAIRS = [(i, j) for i in range(len(NAMES)) for j in range(i, len(NAMES))]
#: The chi-square quantile (5 degrees) of the half of a group that its estimate rests on.
HALF_QUANTILE = 4.3515
#: The chi-square quantile (5 degrees) of 97.5 %, within which rows enter the second estimate, and
#: the factor that makes up for the rows beyond it: 0.975 / P(chi-square of 7 degrees below it).
NEAR_QUANTILE, NEAR_FACTOR = 12.8325, 1.0555
#: Squared distance beyond which a document is rejected, in units where the bulk is chi-square.
CUTOFF = 80.0
#: Rows that a group needs for an estimate of its own.
MIN_ROWS = 200
#: A determinant that falls by less than this (logarithm) has stopped falling.
STILL = 1e-9
_BINS = 16  # bins of the squared distance per power of two


def text_stats(text: bytes | None) -> tuple[int, int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and the lines with a word."""
    text = text or b""
    words = text.split()
    chars = len(b"".join(words).translate(None, _CONTINUED))
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    lines = [line for line in text.split(b"\n") if line.strip()]
    return (
        len(words),
        chars,
        symbols,
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
    )


def repeated_words(words: list[bytes]) -> int:
    """Words inside a 3-word window that the text holds at least twice."""
    if len(words) < 4:
        return 0
    index: dict[bytes, int] = {}
    ids = np.fromiter((index.setdefault(w, len(index)) for w in words), np.int64, len(words))
    pair = ids[:-1] * len(index) + ids[1:]
    if len(index) >= 1 << 20:  # keep the triple below 63 bits
        pair = np.unique(pair, return_inverse=True)[1]
    _, where, counts = np.unique(
        pair[:-1] * len(index) + ids[2:], return_inverse=True, return_counts=True
    )
    again = counts[where] > 1
    hit = np.zeros(len(words), bool)
    for k in range(3):
        hit[k : len(words) - 2 + k] |= again
    return int(hit.sum())


def _features(s: np.ndarray) -> np.ndarray:
    """Statistics (rows x 6) -> transformed vectors, in units of 1/SCALE."""
    words = np.maximum(s[:, 0], 1)
    vectors = np.stack(
        [
            np.log1p(s[:, 0]),
            np.log1p(s[:, 1] / words),
            np.log1p(100 * s[:, 2] / words),
            s[:, 3] / np.maximum(s[:, 5], 1),
            s[:, 4] / words,
        ],
        axis=1,
    )
    return np.clip(np.rint(vectors * SCALE), -LIMIT, LIMIT).astype(np.int32)


def with_stats(docs: DataFrame, carry: list[str]) -> DataFrame:
    """The carried columns of `docs` (which needs `text`) with statistics and vectors."""
    wanted = docs.select(*carry, fill().alias("text"))
    added = [f"{n} long" for n in STATS] + [f"{n} int" for n in NAMES]
    schema = with_columns(wanted.select(*carry), ", ".join(added))

    def run(batches):
        for batch in batches:
            at = [batch.schema.get_field_index(c) for c in carry]
            for part, texts in pieces(batch, "text"):
                s = np.array([text_stats(t) for t in texts], np.int64).reshape(-1, 6)
                f = _features(s.astype(float))
                columns = [part.column(i) for i in at]
                columns += [pa.array(s[:, i]) for i in range(len(STATS))]
                columns += [pa.array(f[:, i]) for i in range(len(NAMES))]
                yield pa.RecordBatch.from_arrays(columns, names=[*carry, *STATS, *NAMES])

    return wanted.mapInArrow(run, schema)


def _key(name: str) -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col(name).cast("string")), F.lit("null"))


def _groups(rows: DataFrame, min_rows: int) -> DataFrame:
    """(lang_key, source_key, grp, fits): whose estimate judges a language and source, and which
    estimates its rows enter: its own, and that of its language and of all rows where needed."""
    counts = rows.groupBy("lang_key", "source_key").count()
    small = F.col("count") < min_rows
    by_lang = counts.groupBy("lang_key")
    by_lang = by_lang.agg(F.sum("count").alias("lang_rows"), F.max(small).alias("lang_small"))
    counts = counts.join(by_lang, "lang_key")
    rest = counts.agg(F.max(F.col("lang_rows") < min_rows).alias("all_small"))
    counts = counts.crossJoin(F.broadcast(rest))
    # the length tells a source from a language whose name looks like it
    own = F.concat_ws("\t", F.length("lang_key"), "lang_key", "source_key")
    lang, large = F.col("lang_key"), F.col("lang_rows") >= min_rows
    fits = [F.when(~small, own), F.when(F.col("lang_small") & large, lang)]
    fits = F.array_compact(F.array(*fits, F.when(F.col("all_small"), F.lit(""))))
    return counts.select(
        "lang_key",
        "source_key",
        F.when(~small, own).when(large, lang).otherwise(F.lit("")).alias("grp"),
        fits.alias("fits"),
    )


def _distance() -> Column:
    """Squared Mahalanobis distance of a vector; `c_*` centre, `w_*` inverse covariance."""
    gap = [F.col(n) / F.lit(float(SCALE)) - F.col(f"c_{n}") for n in NAMES]
    terms = [F.col(f"w_{i}_{j}") * gap[i] * gap[j] for i, j in PAIRS]
    return sum(terms[1:], terms[0])


def _bin(distance: Column) -> Column:
    return F.floor(F.log2(F.greatest(distance, F.lit(2.0**-10))) * _BINS).cast("int")


_PARAMS = ", ".join(
    ["grp string", "logdet double"]
    + [f"c_{n} double" for n in NAMES]
    + [f"w_{i}_{j} double" for i, j in PAIRS]
)


def _solve(frames):
    """Moments of each group -> centre, inverse covariance and log determinant."""
    floor = np.diag(np.square(list(FEATURES.values())))
    for frame in frames:
        n = frame["n"].to_numpy(float)
        mean = np.stack([frame[f"s_{x}"] / n for x in NAMES], axis=1)
        cov = np.zeros((len(frame), len(NAMES), len(NAMES)))
        for i, j in PAIRS:
            cov[:, i, j] = cov[:, j, i] = frame[f"p_{i}_{j}"] / n - mean[:, i] * mean[:, j]
        cov = cov / SCALE**2 + floor
        inverse = np.linalg.inv(cov)
        out = {"grp": frame["grp"], "logdet": np.linalg.slogdet(cov)[1]}
        out |= {f"c_{x}": mean[:, i] / SCALE for i, x in enumerate(NAMES)}
        out |= {f"w_{i}_{j}": inverse[:, i, j] * (1 if i == j else 2) for i, j in PAIRS}
        yield pd.DataFrame(out)


def _moments() -> list[Column]:
    sums = [F.sum(F.col(n).cast("long")).alias(f"s_{n}") for n in NAMES]
    products = [
        F.sum(F.col(NAMES[i]).cast("long") * F.col(NAMES[j])).alias(f"p_{i}_{j}") for i, j in PAIRS
    ]
    return [F.count("*").alias("n"), *sums, *products]


def _starts(vectors: DataFrame, folder: str) -> DataFrame:
    """A first estimate per group: medians, and median distances from them.

    Half of a group can be anything without moving them far. The determinant counts as infinite.
    """
    middle = vectors.groupBy("grp").agg(*[F.percentile(n, F.lit(0.5)).alias(f"m_{n}") for n in NAMES])
    middle = stored(middle, f"{folder}/medians")
    gaps = [F.percentile(F.abs(F.col(n) - F.col(f"m_{n}")), F.lit(0.5)).alias(f"g_{n}") for n in NAMES]
    spread = vectors.join(middle, "grp").groupBy("grp").agg(*gaps).join(middle, "grp")
    inverse = []
    for i, j in PAIRS:
        sd = F.col(f"g_{NAMES[i]}") * (1.4826 / SCALE)
        diagonal = 1 / (sd * sd + FEATURES[NAMES[i]] ** 2)
        inverse.append((diagonal if i == j else F.lit(0.0)).alias(f"w_{i}_{j}"))
    centre = [(F.col(f"m_{n}") / SCALE).alias(f"c_{n}") for n in NAMES]
    return spread.select("grp", F.lit(float("inf")).alias("logdet"), *centre, *inverse)


def _nearest(vectors: DataFrame, params: DataFrame) -> DataFrame:
    """Per group and bin of the distance: moments, and the rows in nearer bins."""
    binned = vectors.join(params.drop("logdet"), "grp").withColumn("bin", _bin(_distance()))
    sums = binned.groupBy("grp", "bin").agg(*_moments())
    whole = Window.partitionBy("grp")
    nearer = whole.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("nearer", F.coalesce(F.sum("n").over(nearer), F.lit(0)))
    return sums.withColumn("rows", F.sum("n").over(whole)).where(
        F.col("nearer") < F.ceil((F.col("rows") + len(NAMES) + 1) / 2)
    )


def estimates(vectors: DataFrame, folder: str) -> DataFrame:
    """One row per group: centre, inverse covariance, and the scale of the bulk's distances.

    `vectors`: a stored table (grp, transformed statistics). Each concentration step is one pass
    with sums per group and bin of the distance, merged in the map tasks, so a group with a third
    of all rows costs no task more than others. All sums are of whole numbers: their order is free.
    A group takes steps until its determinant stops falling; it falls in every one before. The
    half's estimate, scaled, only says which rows are near; all those give the estimate that judges.
    """
    params = _starts(vectors, folder).withColumn("falls", F.lit(True))
    params = stored(params, f"{folder}/start")
    step = 0
    while not (falling := params.where("falls").drop("falls")).isEmpty():
        near = _nearest(vectors, falling).groupBy("grp")
        sums = [f"s_{n}" for n in NAMES] + [f"p_{i}_{j}" for i, j in PAIRS]
        moments = near.agg(F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in sums])
        moved = stored(moments.mapInPandas(_solve, _PARAMS), f"{folder}/moved-{step}")
        last = params.select("grp", F.col("logdet").alias("before"), "falls")
        fell = F.col("falls") & (F.col("logdet") < F.col("before") - STILL)
        better = moved.join(last, "grp").where(fell).drop("before")
        rest = params.join(better.select("grp"), "grp", "left_anti").withColumn("falls", F.lit(False))
        params = stored(better.unionByName(rest), f"{folder}/step-{step}")
        step += 1
    best = params.drop("falls")
    edge = _nearest(vectors, best).groupBy("grp").agg(F.max("bin").alias("edge"))
    scale = F.greatest(F.pow(F.lit(2.0), (F.col("edge") + 1) / _BINS), F.lit(2.0**-9))
    half = best.join(edge, "grp").withColumn("scale", scale / HALF_QUANTILE)
    half = stored(half.drop("edge", "logdet"), f"{folder}/half")
    near = vectors.join(half, "grp").where(_distance() <= NEAR_QUANTILE * F.col("scale"))
    moments = stored(near.groupBy("grp").agg(*_moments()), f"{folder}/near")
    # few rows spread less than what they come from
    few = F.col("n") / F.greatest(F.col("n") - len(NAMES) - 1, F.lit(1))
    scales = moments.select("grp", (few * NEAR_FACTOR).alias("scale"))
    judging = moments.mapInPandas(_solve, _PARAMS).drop("logdet").join(scales, "grp")
    return stored(judging, f"{folder}/estimates")


def base_failed(min_words: int = 50) -> Column:
    return (F.col("n_words") < min_words) | (
        100 * F.col("n_repeat_words") > 50 * F.col("n_words")
    )


def fitted(stats: DataFrame, folder: str, min_rows: int) -> tuple[DataFrame, DataFrame]:
    """The groups and their estimates, from a stored table of statistics."""
    keyed = stats.withColumn("lang_key", _key("lang")).withColumn("source_key", _key("source"))
    groups = stored(_groups(keyed, min_rows), f"{folder}/groups")
    fits = groups.select("lang_key", "source_key", F.explode("fits").alias("grp"))
    in_group = keyed.join(fits, ["lang_key", "source_key"]).select("grp", *NAMES)
    vectors = stored(in_group, f"{folder}/vectors")
    return groups.drop("fits"), estimates(vectors, folder)


def judged(rows: DataFrame, groups: DataFrame, params: DataFrame, cutoff: float) -> DataFrame:
    """`rows` (lang, source, statistics, vectors) with base_failed, distance and kept."""
    keyed = rows.withColumn("lang_key", _key("lang")).withColumn("source_key", _key("source"))
    scored = keyed.join(groups, ["lang_key", "source_key"]).join(params, "grp")
    scored = scored.withColumn("distance", _distance() / F.col("scale"))
    scored = scored.withColumn("base_failed", base_failed())
    near = F.coalesce(F.col("distance") <= cutoff, F.lit(True))
    return scored.withColumn("kept", ~F.col("base_failed") & near)


def quality_verdicts(
    docs: DataFrame, cutoff: float = CUTOFF, min_rows: int = MIN_ROWS
) -> DataFrame:
    """(doc_id, the five statistics, base_failed, kept, distance) per row."""
    folder = work_folder(docs.sparkSession, "quality")
    stats = stored(with_stats(docs, ["doc_id", "lang", "source"]), f"{folder}/stats")
    groups, params = fitted(stats, folder, min_rows)
    found = judged(stats, groups, params, cutoff)
    return found.select("doc_id", *STATS, "base_failed", "kept", F.round("distance", 6).alias("distance"))


def keep_good(docs: DataFrame, cutoff: float = CUTOFF, min_rows: int = MIN_ROWS) -> DataFrame:
    """The rows of `docs` that the rules keep, all columns.

    The statistics are computed again beside whole rows instead of joining texts to verdicts, so
    no text is shuffled and equal or missing ids do no harm.
    """
    folder = work_folder(docs.sparkSession, "quality-kept")
    stats = stored(with_stats(docs, ["lang", "source"]), f"{folder}/stats")
    groups, params = fitted(stats, folder, min_rows)
    whole = docs.select(F.struct("*").alias("doc"), "lang", "source", "text")
    rows = with_stats(whole, ["doc", "lang", "source"])
    return judged(rows, groups, params, cutoff).where("kept").select("doc.*")
