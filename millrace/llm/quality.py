"""Quality rules: fixed base rules, then multivariate outliers by the minimum covariance determinant."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.base import SPACE, SPACE_CHARS, bind, filled, query, read, stripped
from millrace.session import freeze

#: Characters that count as symbols, and the base rules' limits.
SYMBOLS = "#*$%&|<>"
LEAST_WORDS = 50
MOST_REPEATED = 50

CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: The statistics of the vector, and the step at which each is measured: about what one word, symbol or line more makes
#: of a document at the limit of the base rules. It stands in for the spread where a direction of a group has none.
VECTOR = {"t_length": 0.3, "t_word": 0.08, "t_symbols": 0.08, "t_lines": 0.08, "t_repeats": 0.08, "t_capitals": 0.08}


def words_of(text: Column) -> Column:
    trimmed = stripped(text)
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, f"{SPACE}+"))


def without(text: Column, characters: str) -> Column:
    return F.char_length(text) - F.char_length(F.translate(text, characters, ""))


def repeated_words(words: Column) -> Column:
    """Words in windows of three that occur twice or more in the text, the first included.

    A window's hash and place are packed into one long, the hash cut by as many bits as the place needs, so sorting
    longs brings equal windows together. Windows whose cut hashes meet are then compared by their words; only those
    few become strings.
    """
    empty = F.array().cast("array<int>")

    def windows(w):
        n = F.size(w) - 2
        bits = F.length(F.bin(n))
        packed = F.sort_array(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.call_function(
            "shiftleft", F.xxhash64(w[i], w[i + 1], w[i + 2]), bits).bitwiseOR(i.cast("long"))))

        def meet(k):
            head = lambda x: F.call_function("shiftright", x, bits)
            again = F.filter(k, lambda x, i: ((i > 0) & (head(x) == head(F.get(k, i - 1))))
                             | F.coalesce(head(x) == head(F.get(k, i + 1)), F.lit(False)))
            places = F.transform(again, lambda x: x.bitwiseAND(
                F.call_function("shiftleft", F.lit(1).cast("long"), bits) - 1).cast("int"))
            return F.when(F.size(again) > 0, bind(places, lambda p: exact(w, p))).otherwise(empty)

        return bind(packed, meet)

    def exact(w, places):
        said = F.sort_array(F.transform(places, lambda p: F.struct(
            F.concat_ws(" ", w[p], w[p + 1], w[p + 2]).alias("w"), p.alias("p"))))
        return bind(said, lambda s: F.transform(
            F.filter(s, lambda x, i: ((i > 0) & (x["w"] == F.get(s, i - 1)["w"]))
                     | F.coalesce(x["w"] == F.get(s, i + 1)["w"], F.lit(False))), lambda x: x["p"]))

    starts = F.when(F.size(words) < 4, empty).otherwise(windows(words))
    covered = bind(starts, lambda s: F.size(F.array_distinct(F.concat(
        s, F.transform(s, lambda p: p + 1), F.transform(s, lambda p: p + 2)))))
    return covered.cast("long")


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the base statistics and the transformed vector in place of the text (null: no words)."""
    body = filled(text)
    lines = F.filter(F.split(body, "\n"), lambda x: F.regexp_like(x, F.lit(r"[^\x20\x09-\x0D]")))
    parted = docs.withColumn("__body", body).withColumns({"__words": words_of(F.col("__body")), "__lines": lines})
    counted = parted.select(
        *[c for c in docs.columns if c != text],
        F.size("__words").cast("long").alias("n_words"),
        F.char_length(F.translate("__body", SPACE_CHARS, "")).cast("long").alias("word_chars"),
        without(F.col("__body"), SYMBOLS).cast("long").alias("n_symbols"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        bind(F.col("__words"), repeated_words).alias("n_repeat_words"),
        F.size("__lines").alias("n_lines"), without(F.col("__body"), CAPITALS).alias("n_capitals"))
    words = F.greatest(F.col("n_words"), F.lit(1))
    return counted.select(
        *[c for c in counted.columns if c not in ("n_lines", "n_capitals")],
        F.log1p("n_words").alias("t_length"),
        F.log1p(F.col("word_chars") / words).alias("t_word"),
        F.sqrt(F.col("n_symbols") / words).alias("t_symbols"),
        (F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1))).alias("t_lines"),
        (F.col("n_repeat_words") / words).alias("t_repeats"),
        F.sqrt(F.col("n_capitals") / F.greatest(F.col("word_chars"), F.lit(1))).alias("t_capitals"))


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def fit_groups(rows: DataFrame, lang: str, source: str, least: int) -> DataFrame:
    """Add ``fit_lang`` and ``fit_source``: the group whose estimate judges a row.

    A language and source with at least ``least`` fitted rows stand for themselves; smaller ones of a language form
    one group, and languages still too small form one group together. Null is a value of its own.
    """
    rows = rows.withColumns({"fit_lang": F.struct(F.col(lang).isNull().alias("none"), F.coalesce(lang, F.lit("")).alias("name")),
                             "fit_source": F.struct(F.col(source).isNull().alias("none"), F.coalesce(source, F.lit("")).alias("name"))})
    sizes = rows.groupBy("fit_lang", "fit_source").agg(F.count(F.when(~F.col("base_failed"), 1)).alias("n"))
    rest = F.when(F.col("n") >= least, F.col("fit_source"))
    by_lang = sizes.withColumn("own_source", rest).groupBy("fit_lang", "own_source").agg(F.sum("n").alias("pooled"))
    named = (
        sizes.withColumn("own_source", rest).alias("a")
        .join(by_lang.alias("b"), F.col("a.fit_lang").eqNullSafe(F.col("b.fit_lang"))
              & F.col("a.own_source").eqNullSafe(F.col("b.own_source")))
        .select("a.fit_lang", "a.fit_source",
                F.struct(F.when(F.col("pooled") >= least, F.col("a.fit_lang")).alias("lang"),
                         F.when(F.col("pooled") >= least, F.col("a.own_source")).alias("source")).alias("fit_group"))
    )
    return rows.join(freeze(named), ["fit_lang", "fit_source"]).drop("fit_lang", "fit_source")


def spread_of(rows: DataFrame) -> DataFrame:
    """Mean and Cholesky factor of each group's covariance; one row per group.

    Only a pivot below its step, a direction in which the group hardly varies, is replaced by it.
    """
    names = list(VECTOR)
    sums = [F.avg(a).alias(f"m_{a}") for a in names] + [
        F.avg(F.col(a) * F.col(b)).alias(f"p_{i}_{j}") for i, a in enumerate(names) for j, b in enumerate(names[: i + 1])]
    fitted = rows.groupBy("fit_group").agg(F.count("*").alias("n_fit"), *sums)
    for i, a in enumerate(names):
        for j, b in enumerate(names[: i + 1]):
            covariance = F.col(f"p_{i}_{j}") - F.col(f"m_{a}") * F.col(f"m_{b}")
            for k in range(j):
                covariance = covariance - F.col(f"l_{i}_{k}") * F.col(f"l_{j}_{k}")
            entry = F.sqrt(F.greatest(covariance, F.lit(VECTOR[a] ** 2))) if i == j else covariance / F.col(f"l_{j}_{j}")
            fitted = fitted.withColumn(f"l_{i}_{j}", entry)
    return fitted.select("fit_group", "n_fit", *[f"m_{a}" for a in names],
                         *[f"l_{i}_{j}" for i in range(len(names)) for j in range(i + 1)])


def distanced(rows: DataFrame, spreads: DataFrame) -> DataFrame:
    """Add ``d2``, the squared Mahalanobis distance to the row's group; rows of a group without estimate get null."""
    out = rows.join(spreads, F.col("fit_group").eqNullSafe(F.col("__group")), "left")
    for i, a in enumerate(VECTOR):
        z = F.col(a) - F.col(f"m_{a}")
        for k in range(i):
            z = z - F.col(f"l_{i}_{k}") * F.col(f"z_{k}")
        out = out.withColumn(f"z_{i}", z / F.col(f"l_{i}_{i}"))
    d2 = sum((F.col(f"z_{i}") ** 2 for i in range(1, len(VECTOR))), F.col("z_0") ** 2)
    return out.select(*rows.columns, d2.alias("d2"), "n_fit")


def named(spreads: DataFrame) -> DataFrame:
    return spreads.withColumnRenamed("fit_group", "__group")


#: Median of the chi-square distribution with as many degrees of freedom as the vector has statistics.
CHI2_MEDIAN = 5.348


def mcd(rows: DataFrame, least: int = 60, share: float = 0.75, steps: int = 6) -> DataFrame:
    """Add ``distance2`` to ``rows`` (with ``fit_group`` and the vector): robust squared Mahalanobis distances.

    Concentration steps: start from the rows nearest to the group's medians in units of its median deviations; then
    ``steps`` times take mean and covariance of the ``share`` of the group's rows that are nearest, by the distances
    under the estimate before, which can only lower the determinant. The number is fixed, so that the work grows with
    the rows alone; after six, further steps move no distance by much. Distances are scaled so that their median is at
    most the chi-square median. Rows that failed the base rules are judged but never fitted. Each step reads the statistics twice and moves one row per group and task; nothing of
    a group is gathered.
    """
    names = list(VECTOR)
    good = rows.where(~F.col("base_failed"))
    middle = freeze(good.groupBy("fit_group").agg(*[F.percentile_approx(a, 0.5).alias(f"c_{a}") for a in names])
                    .withColumnRenamed("fit_group", "__group"))
    centred = good.join(middle, F.col("fit_group").eqNullSafe(F.col("__group")))
    deviations = freeze(centred.groupBy("__group").agg(
        *[F.percentile_approx(F.abs(F.col(a) - F.col(f"c_{a}")), 0.5).alias(f"w_{a}") for a in names])
        .join(middle.withColumnRenamed("__group", "g2"), F.col("__group").eqNullSafe(F.col("g2"))).drop("g2"))
    started = good.join(deviations, F.col("fit_group").eqNullSafe(F.col("__group")))
    first = sum(((F.col(a) - F.col(f"c_{a}")) / F.greatest(F.col(f"w_{a}"), F.lit(VECTOR[a]))) ** 2 for a in names)
    near = started.select(*rows.columns, first.alias("d2"))
    for _ in range(steps):
        cut = freeze(near.groupBy("fit_group").agg(F.percentile_approx("d2", share, 1000).alias("cut"))
                     .withColumnRenamed("fit_group", "__group"))
        inner = near.join(cut, F.col("fit_group").eqNullSafe(F.col("__group"))).where("d2 <= cut")
        spreads = freeze(named(spread_of(inner)))
        near = distanced(good, spreads).select(*rows.columns, "d2")
    scale = freeze(near.groupBy("fit_group").agg(
        (F.percentile_approx("d2", 0.5, 1000) / CHI2_MEDIAN).alias("scale"), F.count("*").alias("n_good"))
        .withColumnsRenamed({"fit_group": "g2"}))
    judged = distanced(rows, spreads).join(scale, F.col("fit_group").eqNullSafe(F.col("g2")), "left")
    enough = F.col("n_good") >= least
    return judged.select(*rows.columns, F.when(enough, F.col("d2") / F.greatest(F.col("scale"), F.lit(1.0))).alias("distance2"))


#: Columns that ``judge`` makes on its way.
ADDED = (*VECTOR, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals", "base_failed",
         "fit_lang", "fit_source", "fit_group", "n_fit", "n_good", "scale", "cut", "g2", "d2", "distance2", "kept")

#: Squared distance beyond which a document is rejected: the chi-square quantile that one in 100,000 exceeds.
CUT = 33.1


def judge(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", cut: float = CUT,
          least: int = 60) -> DataFrame:
    """``docs`` without the text, with the base statistics, ``base_failed``, ``distance2`` and ``kept``.

    A null text has no words and fails the base rules. Repeated rows and ties are judged alike, a very long text is read
    whole, null is a language and a source of its own. Where a group, its language and the rest together have fewer
    than ``least`` rows, there is no estimate: ``distance2`` is null and the base rules decide alone. An empty table
    gives no rows. Of columns that are called like one that is added, the added one stays.
    """
    docs = docs.drop(*[c for c in ADDED if c not in (text, lang, source)])
    rows = statistics(docs, text).withColumn("base_failed", base_failed())
    rows = freeze(rows)
    grouped = freeze(fit_groups(rows, lang, source, least))
    far = F.coalesce(F.col("distance2") > cut, F.lit(False))
    return mcd(grouped, least).withColumn("kept", ~F.col("base_failed") & ~far)


def keep_good(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, with all their columns."""
    keyed = docs.select(F.col(doc_id).alias("__id"), F.col(text).alias("text"), F.col("lang"), F.col("source"),
                        F.xxhash64(text).alias("__key"))
    # Rows alike in id, text, language and source are judged alike, so one verdict serves them all.
    verdicts = judge(keyed).where("kept").groupBy("__id", "__key", "lang", "source").agg(F.count("*").alias("__n"))
    verdicts = verdicts.withColumnsRenamed({"lang": "__lang", "source": "__source"})
    return docs.withColumn("__text_key", F.xxhash64(text)).join(
        verdicts, (F.col("__text_key") == F.col("__key")) & F.col(doc_id).eqNullSafe(F.col("__id"))
        & F.col("lang").eqNullSafe(F.col("__lang")) & F.col("source").eqNullSafe(F.col("__source")),
        "left_semi").drop("__text_key")


@query("op4_quality_rules")
def quality_rules(spark, folder):
    return judge(read(spark, folder, "documents", "doc_id", "text", "lang", "source")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance2")
