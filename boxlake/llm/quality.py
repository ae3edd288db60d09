"""Quality rules: base statistics of a text, and robust outliers among their transforms, by language and source.

Minimum covariance determinant: from several fixed starts, each concentration step keeps the half of a group with the
smallest distances and takes mean and covariance of those, until the determinant no longer falls; the smallest determinant
of the starts wins, so up to about half of a group may be junk. Reweighting then takes in the rows near the half, and a row
beyond ``cut`` is rejected. All of it is DataFrame expressions: moments and quantiles of a group are
partial aggregates, so a group with a third of all rows is no task of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxlake.llm.common import let
from boxlake.session import Scratch, checkpointed, size_bytes, written

#: The 0.975 quantile of a chi-square with four degrees of freedom, and what makes the covariance of the half,
#: or of the rows within that quantile, consistent at a normal distribution.
CHI2_4_975, HALF_FACTOR, NEAR_FACTOR = 11.1433, 2.10906, 1.06447
#: The half's determinant is too small in a small group of n rows, by 1 - SMALL[0] / n ** SMALL[1] a coordinate.
SMALL = (4.2751, 0.8215)
REWEIGHTINGS = 2
P = 4
FEATURES = [f"f{i}" for i in range(P)]
FITTED = [*[f"m{i}" for i in range(P)], *[f"l{i}{j}" for i in range(P) for j in range(i + 1)]]
#: Fixed value: the 0.999 quantile of a chi-square with four degrees of freedom.
CHI2_4_999 = 18.4668
#: Least standard deviation of a transformed statistic given those before it; keeps a group of near-constant statistics from
#: rejecting all else. Repeats: one heading said twice in a short text lies within three of it, a text of repeats well beyond.
FLOORS = (0.25, 0.05, 0.35, 0.15)
#: Broadcast the fits by language and source up to this size; beyond it, a shuffle joins.
BROADCAST_BYTES = 8 << 20
#: Bytes that the fits of a group take in memory, all starts together, at most.
FIT_BYTES = 2048


def words(text: Column) -> Column:
    """Array of the words: runs of characters other than space and U+0009 to U+000D."""
    return F.array_remove(F.split(text, "[\\x20\\x09-\\x0D]"), "")


def _repeat_words(w: Column, n: Column) -> Column:
    """Words in 3-word windows that occur twice or more, of an array with at least three words.

    Most texts have no two windows of one hash, which a set of longs tells at once. Else windows are packed as (hash bits,
    position) and sorted as plain longs; neighbours with equal bits are candidates, which are compared again by their words.
    What is counted is the union of [position, position + 2].
    """
    window = lambda i: F.concat_ws(" ", F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))
    hashes = F.transform(F.arrays_zip(*[F.slice(w, k, n - 2) for k in (1, 2, 3)]), lambda x: F.xxhash64(x))

    def repeated(hashed: Column, bits: Column) -> Column:
        packed = F.sort_array(F.transform(hashed, lambda h, i: F.call_function("shiftleft", h, bits).bitwiseOR(i.cast("long"))))

        def candidates(s: Column) -> Column:
            alike = F.zip_with(s, F.slice(s, 2, F.size(s)), lambda x, y: F.when(F.call_function("shiftright", x.bitwiseXOR(y), bits) == 0, F.array(x, y)))
            near = F.array_distinct(F.flatten(F.array_compact(alike)))
            mask = F.call_function("shiftleft", F.lit(1).cast("long"), bits) - 1
            return F.sort_array(F.transform(near, lambda x: F.struct(window(x.bitwiseAND(mask).cast("int")).alias("w"), x.bitwiseAND(mask).cast("int").alias("i"))))

        def positions(s: Column) -> Column:
            twice = F.filter(s, lambda x, k: (x["w"] == F.get(s, k + 1)["w"]) | ((k > 0) & (x["w"] == F.get(s, F.greatest(k - 1, F.lit(0)))["w"])))
            return F.sort_array(F.transform(twice, lambda x: x["i"]))

        def covered(p: Column) -> Column:
            return F.aggregate(F.transform(p, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(p, k + 1) - x, F.lit(3)))), F.lit(0), lambda a, x: a + x)

        return let(packed, lambda s: let(candidates(s), lambda c: F.when(F.size(c) == 0, F.lit(0)).otherwise(let(positions(c), covered))))

    return let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(let(F.length(F.bin(n.cast("long"))), lambda bits: repeated(h, bits))))


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: list[str] = ()) -> DataFrame:
    """(id, keep..., n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines) of each whole text; null: empty."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))

    def of_words(w: Column) -> Column:
        n = F.size(w)
        return F.struct(n.cast("long").alias("n_words"), F.length(F.array_join(w, "")).cast("long").alias("word_chars"), F.when(n < 4, F.lit(0)).otherwise(_repeat_words(w, n)).cast("long").alias("n_repeat_words"))

    of_lines = lambda x: F.struct(F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"))
    # Words and lines are bound by lambdas, and all of it by a generator: nothing above can make a text be read twice.
    made = F.struct(let(words(text), of_words).alias("w"), let(lines, of_lines).alias("l"), F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"))
    rows = docs.select(F.col(id_col), *keep, F.explode_outer(F.array(made)).alias("_s"))
    return rows.select(id_col, *keep, "_s.w.n_words", "_s.w.word_chars", "_s.n_symbols", "_s.l.n_dup_lines", "_s.w.n_repeat_words", "_s.l.n_lines")


def transforms() -> list[Column]:
    """Log-scaled length, word length, symbols, and repeats (words and lines), from the statistics.

    Symbols count in per cent, as few of them matter. Repeats count as shares of the text: most texts have none, and in per
    cent a short text's single repeat would lie as far out as a text of nothing else.
    """
    c = F.col
    rate = lambda a, b: a.cast("double") / F.greatest(b, F.lit(1))
    return [F.log1p(c("n_words").cast("double")), F.log1p(c("word_chars") / F.greatest(c("n_words"), F.lit(1))), F.log1p(100.0 * rate(c("n_symbols"), c("word_chars"))), F.log1p(rate(c("n_repeat_words"), c("n_words")) + rate(c("n_dup_lines"), c("n_lines")))]


def _mahalanobis() -> Column:
    """Squared distance by forward substitution through the group's Cholesky factor l_ij and mean m_i."""
    z: list[Column] = []
    for i in range(P):
        v = F.col(FEATURES[i]) - F.col(f"m{i}")
        for j in range(i):
            v = v - F.col(f"l{i}{j}") * z[j]
        z.append(v / F.col(f"l{i}{i}"))
    return sum((v * v for v in z[1:]), z[0] * z[0])


def _cholesky(groups: DataFrame, *keys: str) -> DataFrame:
    """(keys, m_i, l_ij, det) of the covariances c_ij (j <= i); a pivot is its floor at least, so the diagonal is positive."""
    for i in range(P):
        for j in range(i + 1):
            v = F.col(f"c{i}{j}")
            for k in range(j):
                v = v - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            groups = groups.withColumn(f"l{i}{j}", F.sqrt(F.greatest(v, F.lit(FLOORS[i] ** 2))) if i == j else v / F.col(f"l{j}{j}"))
    det = F.col("l00")
    for i in range(1, P):
        det = det * F.col(f"l{i}{i}")
    return groups.select(*keys, *FITTED, det.alias("det"))


def _moments(rows: DataFrame, factor: Column, *keys: str) -> DataFrame:
    """Means and, times ``factor``, covariances of rows: (keys, m_i, l_ij, det)."""
    both = [(i, j) for i in range(P) for j in range(i + 1)]
    sums = rows.groupBy(*keys).agg(*[F.avg(f).alias(f"m{i}") for i, f in enumerate(FEATURES)], *[F.covar_pop(FEATURES[i], FEATURES[j]).alias(f"c{i}{j}") for i, j in both], F.first("n").alias("n"))
    return _cholesky(sums.withColumns({f"c{i}{j}": F.col(f"c{i}{j}") * factor for i, j in both}), *keys)


def _starts(rows: DataFrame, few) -> DataFrame:
    """(g, n, s, m_i, l_ij): centres and spreads by coordinate. Medians with the median deviation (0), which up to half of the
    rows can't move, with the quartiles (1), and means with standard deviations (2)."""
    q = lambda x: F.percentile_approx(x, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), 2000)
    first = checkpointed(rows.groupBy("g").agg(F.count(F.lit(1)).alias("n"), *[x for i, f in enumerate(FEATURES) for x in (q(f).alias(f"q{i}"), F.avg(f).alias(f"a{i}"), F.stddev_pop(f).alias(f"s{i}"))]))
    off = rows.join(few(first), "g").groupBy("g").agg(*[F.percentile_approx(F.abs(F.col(f) - F.col(f"q{i}")[1]), 0.5, 2000).alias(f"d{i}") for i, f in enumerate(FEATURES)])
    wide = first.join(off, "g")
    centres = [[F.col(f"q{i}")[1] for i in range(P)]] * 2 + [[F.col(f"a{i}") for i in range(P)]]
    spreads = [[1.4826 * F.col(f"d{i}") for i in range(P)], [(F.col(f"q{i}")[2] - F.col(f"q{i}")[0]) / 1.349 for i in range(P)], [F.col(f"s{i}") for i in range(P)]]
    out = None
    for s, (m, d) in enumerate(zip(centres, spreads, strict=True)):
        one = wide.select("g", "n", F.lit(s).alias("s"), *[m[i].alias(f"m{i}") for i in range(P)], *[(F.greatest(d[i], F.lit(FLOORS[i])) if i == j else F.lit(0.0)).alias(f"l{i}{j}") for i in range(P) for j in range(i + 1)])
        out = one if out is None else out.unionByName(one)
    return out


def _fit(rows: DataFrame, groups: int) -> DataFrame:
    """(g, m_i, l_ij) by group, for groups of at least one row; ``groups``: their number, which decides how fits meet rows.

    A step counts as long as it lowers the determinant by a millionth; floors bound it from below, so steps end.
    """
    small = HALF_FACTOR / (1.0 - SMALL[0] / F.greatest(F.col("n"), F.lit(8)) ** SMALL[1])
    few = F.broadcast if groups * FIT_BYTES <= BROADCAST_BYTES else (lambda df: df)
    fit = checkpointed(_starts(rows, few).withColumns({"det": F.lit(float("inf")), "done": F.lit(False)}))
    while not (going := fit.filter("not done")).isEmpty():
        near = rows.join(few(going), "g").withColumn("d", _mahalanobis())
        reach = checkpointed(near.groupBy("g", "s").agg(F.percentile_approx("d", 0.5, 2000).alias("reach")).join(few(going), ["g", "s"]))
        inner = rows.join(few(reach), "g").filter(_mahalanobis() <= F.col("reach")).select("g", "s", "n", *FEATURES)
        new = _moments(inner, small, "g", "s").select("g", "s", F.struct(*FITTED, "det").alias("new"))
        falls = F.col("new.det") < F.col("det") * (1 - 1e-6)
        step = fit.join(new, ["g", "s"], "left")
        fit = checkpointed(step.select("g", "n", "s", *[F.when(falls, F.col(f"new.{c}")).otherwise(F.col(c)).alias(c) for c in [*FITTED, "det"]], (~F.coalesce(falls, F.lit(False))).alias("done")))
    best = checkpointed(fit.groupBy("g").agg(F.min_by(F.struct("n", *FITTED), F.struct("det", "s")).alias("b")).select("g", "b.*"))
    for _ in range(REWEIGHTINGS):
        inner = rows.join(few(best), "g").filter(_mahalanobis() <= CHI2_4_975).select("g", "n", *FEATURES)
        best = checkpointed(best.select("g", "n").join(_moments(inner, F.lit(NEAR_FACTOR), "g").drop("det"), "g"))
    return best.drop("n")


def judge(docs: DataFrame, cut: float = CHI2_4_999, least_rows: int = 50, id_col: str = "doc_id", text_col: str = "text", keep: list[str] = ()) -> DataFrame:
    """(id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, distance, keep...).

    base_failed: fewer than 50 words, or more than half of the words in repeated windows. kept: not base_failed, and the
    squared distance within ``cut``. Groups are (lang, source), null being a value of its own; a group of fewer than
    ``least_rows`` passing rows is judged with its language's other small groups; if these are too few too, with all
    languages' such rows; if even these are, by a fit to all passing rows. Only a table of fewer passing rows than that isn't
    judged (distance null, kept true). Empty and null texts fail. Repeated rows give repeated rows; no rows give no rows.
    Other columns, whatever their names, pass through by ``keep`` only, and are never written.
    """
    scratch = Scratch(docs.sparkSession)
    stats = _stats(docs, id_col, text_col, keep)
    # Wide columns are not written: the fit reads the statistics alone, and they are computed again beside what is kept.
    rows = (scratch.written if keep else written)(_stats(docs, id_col, text_col, []), "statistics")
    lookup = written(_lookup(rows.filter("not base_failed"), least_rows), "fits")
    lookup = F.broadcast(lookup) if size_bytes(lookup) <= BROADCAST_BYTES else lookup
    scratch.clear()
    out = (stats if keep else rows).join(lookup, ["_lang", "_source"], "left").withColumn("distance", _mahalanobis())
    kept = ~F.col("base_failed") & F.coalesce(F.col("distance") <= cut, F.lit(True))
    return out.select(F.col("_id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"), "distance", *[F.col(f"_keep_{c}").alias(c) for c in keep])


def _stats(docs: DataFrame, id_col: str, text_col: str, keep: list[str]) -> DataFrame:
    """(_id, _keep_..., _lang, _source, statistics, base_failed, transforms) of each row; null is a value of its own."""
    value = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit(""))
    named = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), *[F.col(c).alias(f"_keep_{c}") for c in keep], value("lang").alias("_lang"), value("source").alias("_source"))
    stats = statistics(named, "_id", "_text", [*[f"_keep_{c}" for c in keep], "_lang", "_source"])
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return stats.withColumn("base_failed", failed).withColumns(dict(zip(FEATURES, transforms(), strict=True)))


def _lookup(passing: DataFrame, least_rows: int) -> DataFrame:
    """(_lang, _source, m_i, l_ij): the fit that judges each (language, source)."""
    counts = passing.groupBy("_lang", "_source").count()
    wide = counts.withColumn("g", F.when(F.col("count") >= least_rows, F.struct("_lang", "_source")).otherwise(F.struct("_lang", F.lit("small").alias("_source"))))
    groups = wide.withColumn("g", F.to_json("g"))
    sizes = groups.groupBy("g").agg(F.sum("count").alias("n")).filter(F.col("n") >= least_rows)
    # No group's name is "rest": names are JSON objects.
    groups = checkpointed(groups.join(sizes, "g", "left").select("_lang", "_source", "count", F.when(F.col("n").isNotNull(), F.col("g")).otherwise("rest").alias("g")))
    rest, every, n = groups.agg(F.sum(F.when(F.col("g") == "rest", F.col("count"))), F.sum("count"), F.count(F.lit(1))).first()
    if (every or 0) < least_rows:
        groups = groups.limit(0)
    members = groups
    if 0 < (rest or 0) < least_rows:
        members = groups.filter("g <> 'rest'").unionByName(groups.withColumn("g", F.lit("rest")))
    few = F.broadcast if n * FIT_BYTES <= BROADCAST_BYTES else (lambda df: df)
    fit = _fit(passing.join(few(members), ["_lang", "_source"]).select("g", *FEATURES), n + 1)
    return groups.join(fit, "g").drop("g", "count")
