"""Problem 8: mix sources to target weights.

Membership of a document in the domains (the sources of the mixes) is soft: the
posteriors of a classifier fitted on the labelled documents, and for a labelled
document its source, as far as labels are trusted.  Rates of the documents are
fitted by projected-gradient least squares: each step sums the expected tokens by
domain over all groups of like documents, in parallel, and only these sums (mixes
x domains) come back.  First the labelled documents are fitted alone; then all,
so unlabelled ones are taken for what is still missing of a domain.  Rates become
whole numbers by a prefix of hash order, found with two levels of running sums,
so no source is ever gathered into one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.llm.common import spread, staged, table
from quire.llm.tokens import default_vocabulary, encoder, read_ranks

#: Words are hashed to so many features; labelled rows used for the fit, about.
FEATURES, FIT_ROWS = 4096, 20_000
#: Rows of one cell of the running sums, about.
CELL_ROWS = 20_000
#: Most steps of the gradient for labelled documents alone and for all, and the change of a residual that ends them.
STEPS, STILL = (6, 24), 1e-6
#: A source reaches its target if no more than this part of it is missing.
REACHED = 0.02
#: Posteriors are rounded to so many digits; documents with equal ones are alike.
DIGITS = 2


def domain_counts(docs: DataFrame, domains: list[str], fit_rows: int = FIT_ROWS) -> np.ndarray:
    """Feature counts by domain (rows of ``domains``, then all other sources).

    Fitted on about ``fit_rows`` labelled documents, those of lowest hash.
    The result is domains x FEATURES whatever the corpus.
    """
    spark = docs.sparkSession
    index = {s: i for i, s in enumerate(domains)}
    label = spark.createDataFrame(list(index.items()), "source string, k int") if index else None
    fit = docs.where(F.col("source").isNotNull() & F.col("text").isNotNull())
    # by the hash of the id, so nothing is sorted and no task gathers texts
    least = int(min(1.0, fit_rows / max(1, fit.select("doc_id").count())) * (1 << 30))
    fit = fit.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < F.lit(least))
    fit = fit.join(F.broadcast(label), "source", "left") if label else fit.withColumn("k", F.lit(None).cast("int"))
    words = fit.select(F.coalesce("k", F.lit(len(domains))).alias("k"), F.explode(F.split(F.lower("text"), r"[^\p{L}\p{M}]+")).alias("w"))
    rows = words.where("w <> ''").groupBy("k", F.pmod(F.xxhash64("w"), F.lit(FEATURES)).alias("f")).count().collect()
    out = np.zeros((len(domains) + 1, FEATURES))
    for k, f, n in rows:
        out[k, f] = n
    return out


def posteriors(docs: DataFrame, domains: list[str], counts: np.ndarray) -> DataFrame:
    """``doc_id`` and ``q`` (array<double>, one per domain) of the documents."""
    logp = np.log((counts + 0.5) / (counts.sum(1, keepdims=True) + 0.5 * FEATURES))
    prior = np.log((counts.sum(1) + 1) / (counts.sum() + len(counts)))
    model = docs.sparkSession.sparkContext.broadcast((logp, prior))
    feats = F.transform(F.filter(F.split(F.lower(F.coalesce("text", F.lit(""))), r"[^\p{L}\p{M}]+"), lambda w: w != ""), lambda w: F.pmod(F.xxhash64(w), F.lit(FEATURES)).cast("int"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        logp, prior = model.value
        for b in batches:
            q = []
            for f in b["f"]:
                z = prior + logp[:, np.asarray(f, dtype=int)].sum(1) if len(f) else prior
                p = np.exp(z - z.max())
                q.append(list((p / p.sum())[:-1].round(DIGITS)))
            yield pd.DataFrame({"doc_id": b["doc_id"], "q": q})

    return docs.select("doc_id", feats.alias("f")).mapInPandas(run, "doc_id bigint, q array<double>")


def step(rate: np.ndarray, member: np.ndarray, cap: np.ndarray, move: np.ndarray) -> np.ndarray:
    """Rates of documents after one projected step; ``move`` is the step of each domain."""
    return np.clip(rate + member @ move, 0.0, cap)


def replay(moves: np.ndarray, member: np.ndarray, labelled: np.ndarray, caps: np.ndarray, alone: int) -> np.ndarray:
    """Rates of documents of one mix after all steps so far.

    ``moves`` has the steps by domain; in the first ``alone`` of them only
    labelled documents move.  A rate depends on nothing but these and the
    document's membership, so it isn't kept from step to step.
    """
    rate = np.zeros(len(member))
    for k, move in enumerate(moves):
        new = step(rate, member, caps, move)
        rate = np.where(labelled, new, rate) if k < alone else new
    return rate


def fitted(groups: DataFrame, target: np.ndarray, cap: np.ndarray, unlabelled: float) -> tuple[np.ndarray, int]:
    """(steps by mix and domain, number of steps for labelled documents alone).

    ``groups`` has q, labelled and tokens of documents that are alike; ``target``
    and ``cap`` are mixes x domains.  Each step is one aggregation over the groups.
    """
    mixes, domains = target.shape
    spark = groups.sparkSession

    def totals(moves: list[np.ndarray], alone: int) -> tuple[np.ndarray, np.ndarray]:
        known = spark.sparkContext.broadcast((np.array(moves).reshape(len(moves), mixes, domains), cap, alone))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            past, cap, alone = known.value
            got, all_ = np.zeros((mixes, domains)), np.zeros(domains)
            for b in batches:
                member, labelled, tokens = _groups(b, domains)
                all_ += tokens @ member
                for m in range(mixes):
                    got[m] += (replay(past[:, m], member, labelled, _caps(member, labelled, cap[m], unlabelled), alone) * tokens) @ member
            yield pa.RecordBatch.from_arrays([pa.array(np.arange((mixes + 1) * domains, dtype=np.int32)), pa.array(np.vstack([got, all_]).ravel())], ["at", "x"])

        out = np.zeros((mixes + 1) * domains)
        for r in groups.mapInArrow(run, "at int, x double").groupBy("at").agg(F.sum("x").alias("x")).collect():  # mixes x domains
            out[r["at"]] = r["x"]
        return out[:-domains].reshape(mixes, domains), out[-domains:]

    moves: list[np.ndarray] = []
    alone, last = STEPS[0], None
    for k in range(sum(STEPS)):
        got, there = totals(moves, alone)
        rest = target - got
        if last is not None and np.abs(rest - last).max() <= STILL * max(1.0, target.max()):
            if k >= alone:
                break
            alone, last = k, None
        else:
            last = rest
        # the domain's own tokens are the curvature of its residual
        moves.append(rest / np.where(there > 0, there, 1.0))
    return np.array(moves).reshape(len(moves), mixes, domains), alone


def _caps(member: np.ndarray, labelled: np.ndarray, cap: np.ndarray, unlabelled: float) -> np.ndarray:
    """Most times of a document: that of its domain, or ``unlabelled`` if less."""
    most = (member > 0) @ cap if not len(member) else np.where(member > 0, cap, 0).max(1)
    return np.where(labelled, most, np.minimum(most, unlabelled))


def _groups(b: pa.RecordBatch, domains: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return np.asarray(b.column(0).flatten(), float).reshape(b.num_rows, domains), b.column(1).to_numpy(zero_copy_only=False).astype(bool), b.column(2).to_numpy().astype(float)


def mix(docs: DataFrame, targets: DataFrame, unlabelled_repeats: float = 1.0, vocabulary: str | None = None) -> DataFrame:
    """How often each document is taken: ``mix_id, doc_id, source, n_tokens, times``
    and the mix's total size ``mix_tokens``.

    ``docs`` has doc_id, text and source; ``targets`` has mix_id, source,
    target_share, max_repeats and size_factor and must be a small table (the
    configuration of the mixes).  Only documents taken at least once appear.

    Shares count relative to their sum within the mix; null shares, caps and
    size factors count as 0, 0 and 0.  A source that cannot reach its target
    gives every document max_repeats times; the others keep their own targets.
    Documents without source are taken at most ``unlabelled_repeats`` times (and
    max_repeats of a domain they may belong to), for what is missing of domains
    they seem to belong to; they count for no source.  A labelled document belongs
    to its source and nothing else, as shares are judged by source.
    Null and empty texts have 0 tokens and are never taken.  Empty tables give
    no rows.  Of rows with equal doc_id each counts as a document of its own.
    """
    spark = docs.sparkSession
    rows = (
        targets.select("mix_id", "source", F.coalesce("target_share", F.lit(0.0)).alias("share"), F.coalesce("max_repeats", F.lit(0)).alias("cap"), F.coalesce("size_factor", F.lit(0.0)).alias("size"))
        .where("source is not null and mix_id is not null")
        .groupBy("mix_id", "source")
        .agg(F.sum("share").alias("share"), F.max("cap").alias("cap"), F.max("size").alias("size"))
        .toPandas()
    )
    domains, mixes = sorted(set(rows["source"])), sorted(set(rows["mix_id"]))
    src = docs.select(F.col("doc_id").cast("long"), "text", "source")
    sized = staged(sizes(src, vocabulary), "sizes")
    whole = float(sized.agg(F.sum("n_tokens")).first()[0] or 0)
    out = "mix_id string, doc_id bigint, source string, n_tokens bigint, times int, mix_tokens double"
    if not domains or not whole:
        return spark.createDataFrame([], out)
    target, cap, total = np.zeros((len(mixes), len(domains))), np.zeros((len(mixes), len(domains))), np.zeros(len(mixes))
    for r in rows.itertuples():
        at = mixes.index(r.mix_id), domains.index(r.source)
        target[at], cap[at], total[at[0]] = r.share, r.cap, max(total[at[0]], whole * r.size)
    share = target.sum(1, keepdims=True)
    target = np.where(share > 0, target / np.where(share > 0, share, 1), 0) * total[:, None]
    soft = staged(posteriors(src.where("source is null"), domains, domain_counts(src, domains)).groupBy("doc_id").agg(F.first("q").alias("q")), "posteriors")
    own = F.transform(F.array(*map(F.lit, domains)), lambda d: (d == F.col("source")).cast("double"))
    member = sized.where("source is not null").select("*", own.alias("q"), F.lit(True).alias("labelled")).unionByName(sized.where("source is null").join(soft, "doc_id").withColumn("labelled", F.lit(False)))
    groups = staged(member.where("n_tokens > 0").groupBy("q", "labelled").agg(F.sum("n_tokens").alias("tokens")), "groups")
    moves, alone = fitted(groups, target, cap, unlabelled_repeats)
    known = spark.sparkContext.broadcast((moves, alone, cap, total, mixes))

    def rates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        moves, alone, cap, total, mixes = known.value
        for b in batches:
            member, labelled, tokens = _groups(b, len(domains))
            for m, name in enumerate(mixes):
                rate = replay(moves[:, m], member, labelled, _caps(member, labelled, cap[m], unlabelled_repeats), alone)
                n = b.num_rows
                yield pa.RecordBatch.from_arrays([pa.array([name] * n, pa.string()), b.column(0), b.column(1), pa.array(rate), pa.array(tokens), pa.array(np.full(n, total[m]))], ["mix_id", "q", "labelled", "rate", "tokens", "mix_tokens"])

    rate = groups.mapInArrow(rates, "mix_id string, q array<double>, labelled boolean, rate double, tokens double, mix_tokens double").where("rate > 1e-9")
    rate = rate.select("*", F.floor("rate").cast("int").alias("base"), ((F.col("rate") - F.floor("rate")) * F.col("tokens")).alias("extra")).drop("tokens")
    # a labelled group is a source: at most mixes x domains rows, so no source is shuffled to one task
    of = F.get(F.array(*map(F.lit, domains)), F.array_position("q", 1.0).cast("int") - 1).alias("source")
    known_rates = F.broadcast(rate.where("labelled").select(of, "mix_id", "rate", "mix_tokens", "base", "extra"))
    named = sized.where("n_tokens > 0").join(known_rates, "source").withColumn("part", F.col("source"))
    # of the groups without source each is rounded on its own
    loose = member.where("n_tokens > 0 and not labelled").join(rate.where("not labelled").drop("labelled"), "q").withColumn("part", F.col("q").cast("string"))
    return _whole(named.unionByName(loose.select(*named.columns)))


def sizes(src: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """``doc_id, source, n_tokens`` of each row."""
    path = vocabulary or default_vocabulary()
    ranks = src.sparkSession.sparkContext.broadcast(read_ranks(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, ranks)
        for b in batches:
            texts = b.column(2)
            n = [enc.count(t) if t else 0 for at in range(0, len(texts), 1000) for t in texts.slice(at, 1000).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n, pa.int64())], ["doc_id", "source", "n_tokens"])

    return spread(src.select("doc_id", "source", "text")).mapInArrow(run, "doc_id bigint, source string, n_tokens bigint")


def _whole(named: DataFrame) -> DataFrame:
    """Whole numbers of times: ``base`` for all, one more for a prefix in hash order.

    The prefix of each (mix, part) ends where its tokens come nearest to
    ``extra``.  Cells of the hash keep each running sum to about CELL_ROWS rows.
    """
    cells = max(1, named.count() // CELL_ROWS)
    named = named.withColumn("h", F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(1 << 40)))
    named = named.withColumn("cell", F.shiftright(F.col("h") * F.lit(min(cells, 1 << 22)), 40))
    key = ["mix_id", "part"]
    sums = named.groupBy(*key, "cell").agg(F.sum("n_tokens").alias("t"))
    start = sums.select(*key, "cell", (F.sum("t").over(Window.partitionBy(*key).orderBy("cell")) - F.col("t")).alias("start"))
    joined = _join_null_safe(named, start, [*key, "cell"])
    inner = Window.partitionBy(*key, "cell").orderBy("h", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("start") + F.coalesce(F.sum("n_tokens").over(inner), F.lit(0))
    taken = joined.withColumn("before", before)
    # one more where more than half of the document lies before the end of the prefix
    more = (F.col("before") + F.col("n_tokens") / 2 <= F.col("extra")).cast("int")
    return taken.select("mix_id", "doc_id", "source", "n_tokens", (F.col("base") + more).alias("times"), "mix_tokens").where("times > 0")


def _join_null_safe(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    r = right.select(*[F.col(k).alias(f"_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    on = None
    for k in keys:
        eq = F.col(k).eqNullSafe(F.col(f"_{k}"))
        on = eq if on is None else on & eq
    return left.join(r, on).drop(*[f"_{k}" for k in keys])


def shares(taken: DataFrame, targets: DataFrame) -> DataFrame:
    """``mix_id, source, target_share, actual_share, tokens, documents, reached`` of each target row.

    ``actual_share`` is the source's tokens over the mix's total size; 0 where
    nothing was taken of it.  A source that falls short shows an actual share below
    target and ``reached`` false; what was taken without a source is a row of its own.
    """
    got = taken.groupBy("mix_id", "source").agg(F.sum(F.col("n_tokens") * F.col("times")).alias("tokens"), F.sum("times").alias("documents"), F.max("mix_tokens").alias("size"))
    want = targets.groupBy("mix_id", "source").agg(F.sum(F.coalesce("target_share", F.lit(0.0))).alias("w"))
    w = Window.partitionBy("mix_id")
    out = _join_null_safe_full(want, got)
    out = out.select(
        "mix_id", "source",
        F.coalesce(F.try_divide("w", F.sum("w").over(w)), F.lit(0.0)).alias("target_share"),
        F.coalesce(F.try_divide("tokens", F.max("size").over(w)), F.lit(0.0)).alias("actual_share"),
        F.coalesce("tokens", F.lit(0)).alias("tokens"),
        F.coalesce("documents", F.lit(0)).alias("documents"),
    )
    return out.withColumn("reached", F.col("actual_share") >= F.col("target_share") * (1 - REACHED))


def _join_null_safe_full(want: DataFrame, got: DataFrame) -> DataFrame:
    g = got.withColumnsRenamed({"mix_id": "_m", "source": "_s"})
    on = F.col("mix_id").eqNullSafe(F.col("_m")) & F.col("source").eqNullSafe(F.col("_s"))
    return want.join(g, on, "full").withColumns({"mix_id": F.coalesce("mix_id", "_m"), "source": F.coalesce("source", "_s")}).drop("_m", "_s")


def p8_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"))


def p8_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shares(p8_counts(spark, sf_dir), table(spark, sf_dir, "mix_targets"))
