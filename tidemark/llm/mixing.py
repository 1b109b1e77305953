"""Mixing to target weights with soft membership.

A labelled table trains a classifier, which gives every document a posterior over domains.
A rate for each document is then fitted so that the expected tokens of each domain meet the
targets: with n the tokens and p the posteriors of a document, minimise the distance of
``sum(n * p * rate)`` from the target totals over rates that are not negative, by projected
gradients. A rate depends on a document's own n and p and on one gradient of as many numbers
as there are domains per step. A step is one aggregation over a stored table of small rows;
only those numbers reach the driver.

Everything is built-in functions. No text is moved: what is shuffled are counts, and a few numbers for each document.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialise, temporary, words_of
from tidemark.session import broadcast_within

#: labelled documents the classifier is fitted on at most, taken by a hash of their id
MAX_LABELLED = 20_000
#: places that words are hashed to; each has a weight for every domain
PLACES = 1 << 18
SMOOTHING = 0.5
#: the softmax regression: steps, their size, the weight of large coefficients, and where features are cut off
ROUNDS, RATE, RIDGE, CUT = 800, 0.5, 1e-3, 5.0
STEPS = 40
#: documents whose keys (12 bytes) are sent to all tasks
MAX_BROADCAST_KEPT = 2_000_000
#: a fit ends when no domain is further from its target than this share of all tokens, or steps change nothing
TOLERANCE = 1e-6
#: targets count as met if no domain is further away than this share of all tokens
MET = 1e-3
#: rates are rounded to so many decimals, so that the order of sums doesn't show
DECIMALS = 6


def _place(word: Column) -> Column:
    """The place of a word, without the punctuation around it, in lower case."""
    return F.pmod(F.xxhash64(F.lower(F.btrim(word, F.lit(".,;:!?\"()")))), F.lit(PLACES)).cast("int")


def _text_keys(text: str) -> list[Column]:
    """What stands for a text where it is not moved itself."""
    return [F.xxhash64(text), F.hash(text)]


def _style(text: Column, words: str) -> list[Column]:
    """What a text looks like: symbols, capitals, ends of sentences, repeated words and lines, lengths."""
    n = F.greatest(F.size(words), F.lit(1))
    dense = F.greatest(F.length(F.array_join(words, "")), F.lit(1))
    lines = F.filter(F.split(text, "\n"), lambda x: F.trim(x) != "")

    def count(others: str) -> Column:
        return F.length(F.regexp_replace(text, others, ""))

    return [
        count(r"[^#*$%&|<>]+") / dense,
        count(r"[^A-Z]+") / dense,
        count(r"[^.!?]+") / n,
        F.size(F.array_distinct(words)) / n,
        (F.size(lines) - F.size(F.array_distinct(lines))) / F.greatest(F.size(lines), F.lit(1)),
        F.log1p(F.size(words)),
        dense / n,
    ]


class Classifier:
    """Naive Bayes weights for every place, and a softmax regression on what they say and on the style.

    The words of a text give each domain two figures, the mean and the largest of their weights. These and the
    style, each also squared, decide. All tables are of bounded size: ``weights`` has a row for each place at most.
    """

    def __init__(self, domains: list[str], weights: DataFrame, centre: np.ndarray, spread: np.ndarray, theta: np.ndarray):
        self.domains, self.weights, self.centre, self.spread, self.theta = domains, weights, centre, spread, theta

    @staticmethod
    def features(df: DataFrame, weights: DataFrame, n_domains: int, words: str, figures: str) -> DataFrame:
        """``df`` with the number of ``words`` and the column ``figures`` in place of its ``text``.

        Words meet their weights one by one, and are aggregated by text before anything moves: a row of a few
        numbers for each text. Copies of a text have the same means and maxima, so they need not be told apart.
        """
        a, b, place = temporary("a", "b", "place")
        keys = [k.alias(n) for k, n in zip(_text_keys("text"), (a, b))]
        # keys are made before words are parted: what stands beside an explode is evaluated for every word
        each = df.select(*keys, words_of(F.col("text")).alias(place)).select(a, b, F.explode(place).alias(place))
        each = each.withColumn(place, _place(F.col(place)))
        met = each.join(F.broadcast(weights.withColumnRenamed("place", place)), place, "left")
        w = [F.coalesce(f"w{i}", F.lit(0.0)) for i in range(n_domains)]
        told = [f(x).alias(f"{n}{i}") for n, f in (("mean", F.avg), ("top", F.max)) for i, x in enumerate(w)]
        told = met.groupBy(a, b).agg(*told)
        names = [f"{n}{i}" for n in ("mean", "top") for i in range(n_domains)]
        (of_words,) = temporary("told")
        told = told.select(a, b, F.array(*[F.round(n, 9) for n in names]).alias(of_words))
        df = df.withColumn(words, words_of(F.col("text")))
        df = df.withColumn(figures, F.array(*_style(F.coalesce(F.col("text"), F.lit("")), words)))
        # texts and words end here: only their numbers go on into the join
        rest = [f"`{c}`" for c in df.columns if c not in ("text", words)]
        df = df.select(*rest, F.size(words).alias(words), *keys).join(told, [a, b], "left").drop(a, b)
        none = F.lit([0.0] * len(names))
        return df.withColumn(figures, F.concat(figures, F.coalesce(of_words, none))).drop(of_words)

    def posteriors(self, figures: str) -> list[Column]:
        """A probability for each domain from the column of figures."""
        if len(self.domains) == 1:
            return [F.lit(1.0)]
        k = len(self.centre)
        x = F.transform(
            F.arrays_zip(F.col(figures).alias("x"), F.lit([float(v) for v in self.centre]).alias("m"), F.lit([float(v) for v in self.spread]).alias("s")),
            lambda t: F.greatest(F.lit(-CUT), F.least(F.lit(CUT), (t["x"] - t["m"]) / t["s"])),
        )

        def score(theta: np.ndarray) -> Column:
            # theta: for one, for each figure, for each of their squares
            pairs = F.lit([[float(a), float(b)] for a, b in zip(theta[1 : k + 1], theta[k + 1 :])])
            terms = F.zip_with(x, pairs, lambda v, t: v * (F.get(t, 0) + v * F.get(t, 1)))
            return F.aggregate(terms, F.lit(float(theta[0])), lambda a, v: a + v)

        scores = [score(t) for t in self.theta.T]
        top = F.greatest(*scores)
        powers = [F.exp(s - top) for s in scores]
        total = sum(powers[1:], powers[0])
        return [p / total for p in powers]


def _softmax(x: np.ndarray, y: np.ndarray, n_domains: int) -> np.ndarray:
    """Coefficients of a regression of domains (numbers) on rows of figures, by plain gradients."""
    theta, goal = np.zeros((x.shape[1], n_domains)), np.eye(n_domains)[y]
    for _ in range(ROUNDS if len(y) else 0):
        z = x @ theta
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        theta -= RATE * (x.T @ (p - goal) / len(y) + RIDGE * theta)
    return theta.round(6)


def fit_classifier(docs: DataFrame, labels: DataFrame, domains: list[str], max_labelled: int = MAX_LABELLED) -> Classifier:
    """Fit on at most ``max_labelled`` labelled documents: words on one half, the regression on the other.

    ``labels`` has ``doc_id`` and ``domain``; nulls and domains not asked for are ignored, and
    of several domains of a document the first by name counts.
    """
    words, figures, half = temporary("words", "figures", "half")
    known = labels.where(F.col("doc_id").isNotNull() & F.col("domain").isin(domains))
    known = known.groupBy("doc_id").agg(F.min("domain").alias("domain"))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled)
    # At most max_labelled ids and names: small enough to send to all.
    seen = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")
    seen = materialise(seen.withColumn(half, F.pmod(F.xxhash64(F.lit("half"), "doc_id"), F.lit(2))), "labelled")

    first = seen.where(F.col(half) == 0).select("doc_id", "domain", F.array_distinct(words_of(F.col("text"))).alias(words))
    counts = {r["domain"]: r["n"] for r in first.groupBy("domain").agg(F.count("*").alias("n")).collect()}
    n = [float(counts.get(d, 0)) for d in domains]
    each = first.select("doc_id", "domain", F.explode(words).alias("place")).withColumn("place", _place(F.col("place"))).distinct()
    table = each.groupBy("place").agg(*[F.count_if(F.col("domain") == d).alias(f"c{i}") for i, d in enumerate(domains)])
    c = [F.col(f"c{i}") for i in range(len(domains))]
    all_c = sum(c[1:], c[0])

    def odds(k: int) -> Column:
        inside = (c[k] + SMOOTHING) / (n[k] + 2 * SMOOTHING)
        return F.log(inside / ((all_c - c[k] + SMOOTHING) / (sum(n) - n[k] + 2 * SMOOTHING)))

    # at most PLACES rows, fit for a broadcast
    weights = materialise(table.select("place", *[F.round(odds(k), 4).alias(f"w{k}") for k in range(len(domains))]), "weights")

    rows = Classifier.features(seen.where(F.col(half) == 1).select("doc_id", "domain", "text"), weights, len(domains), words, figures)
    rows = rows.select("doc_id", "domain", figures).orderBy("doc_id", "domain", figures).collect()  # at most max_labelled
    x = np.array([r[figures] for r in rows], float).reshape(len(rows), -1 if rows else 7 + 2 * len(domains))
    centre, spread = (x.mean(axis=0), x.std(axis=0) + 1e-6) if len(x) else (np.zeros(x.shape[1]), np.ones(x.shape[1]))
    centre, spread = centre.round(6), spread.round(6)
    z = np.clip((x - centre) / spread, -CUT, CUT)
    theta = _softmax(np.hstack([np.ones((len(z), 1)), z, z * z]), np.array([domains.index(r["domain"]) for r in rows], int), len(domains))
    return Classifier(domains, weights, centre, spread, theta)


def _rate(steps: list[np.ndarray], p: list[Column], start: float, cap: float | None) -> Column:
    """The rate after the given steps: each moves along the posteriors and is projected onto [0, cap]."""
    if not steps:
        return F.lit(start)

    def move(r: Column, step: Column) -> Column:
        down = [pk * F.get(step, k) for k, pk in enumerate(p)]
        r = F.greatest(r - sum(down[1:], down[0]), F.lit(0.0))
        return r if cap is None else F.least(r, F.lit(cap))

    return F.aggregate(F.lit([[float(x) for x in s] for s in steps]), F.lit(start), move)


def mix(
    docs: DataFrame,
    labels: DataFrame,
    targets: dict[str, float],
    budget: float | None = None,
    anchor: str | None = None,
    headroom: float = 0.0,
    max_rate: float | None = None,
    carry: list[str] | None = None,
    max_labelled: int = MAX_LABELLED,
) -> DataFrame:
    """``carry`` (default: all) columns of ``docs`` with ``n_tokens``, ``p_<domain>``, ``rate`` and ``copies``.

    ``targets`` names the domains and their weights, which are scaled to sum to one; a weight
    of zero asks for no tokens. The totals are the weights times ``budget`` tokens, by default
    all there are; with an ``anchor`` instead, times as many as make that domain's target its
    own expected tokens, and ``headroom`` as a share more. Rates start at one, for the natural
    mix, and lie in [0, ``max_rate``]. ``copies`` is the rate rounded up or down at random by a
    hash of ``doc_id``, so that its expectation is the rate.

    ``docs`` needs ``doc_id`` and ``text``; columns with the names of results are replaced. A
    null or empty text has no tokens: it weighs nothing in the fit and gets the rate of its
    posterior. Rows without a ``doc_id`` take part like others and are rounded alike. Repeated
    rows each count and get equal rates. Targets that no rates meet, as those of domains without
    tokens or beyond ``max_rate``, are approached in tokens: the sum of squared distances falls.
    An empty table gives an empty result.
    """
    domains = sorted(targets)
    if not domains or min(targets.values()) < 0 or sum(targets.values()) <= 0:
        raise ValueError("targets need domains with weights that are not negative and not all zero")
    weights = np.array([targets[d] for d in domains], float) / sum(targets.values())
    model = fit_classifier(docs, labels, domains, max_labelled)
    names = [f"p_{d}" for d in domains]
    new = {"n_tokens", "rate", "copies", *names}
    carried = [c for c in (docs.columns if carry is None else carry) if c not in new]
    words, figures = temporary("words", "figures")
    (text,) = temporary("text")  # what is carried stays beside it
    staged = docs.select(*[F.col(f"`{c}`").alias(text if c == "text" else c) for c in carried], "text")
    staged = Classifier.features(staged, model.weights, len(domains), words, figures)
    staged = staged.select(
        *[F.col(f"`{text if c == 'text' else c}`").alias(c) for c in carried],
        F.col(words).cast("long").alias("n_tokens"),
        *[c.alias(name) for c, name in zip(model.posteriors(figures), names)],
    )
    staged = materialise(staged, "posteriors")

    p, n = [F.col(c) for c in names], F.col("n_tokens")
    pairs = [(i, j) for i in range(len(p)) for j in range(i, len(p))]
    sums = staged.agg(
        *[F.coalesce(F.sum(n * p[i] * p[j]), F.lit(0.0)).alias(f"m{i}_{j}") for i, j in pairs],
        *[F.coalesce(F.sum(n * x), F.lit(0.0)).alias(f"s{i}") for i, x in enumerate(p)],
    ).first()
    gram = np.array([[sums[f"m{min(i, j)}_{max(i, j)}"] for j in range(len(p))] for i in range(len(p))])
    have = np.array([sums[f"s{i}"] for i in range(len(p))])
    if anchor is not None:
        k = domains.index(anchor)
        budget = have[k] * (1 + headroom) / weights[k]
    goal = weights * (have.sum() if budget is None else budget)

    def fit(scale: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
        """Steps from the natural mix, each the distance left times ``scale``, and the totals they end at."""
        steps: list[np.ndarray] = []
        total = have
        for _ in range(STEPS if have.sum() else 0):
            if np.abs(total - goal).max() <= TOLERANCE * goal.sum():
                break
            steps.append(scale @ (total - goal))
            rate = _rate(steps, p, 1.0, max_rate)
            row = staged.select(rate.alias("r"), n.alias("n"), *names).agg(*[F.sum(F.col("n") * F.col("r") * x) for x in p]).first()
            before, total = total, np.array(row, float)
            if np.abs(total - before).max() <= TOLERANCE / 100 * goal.sum():
                break
        return steps, total

    # Targets that can be met are met by any metric, and soonest by the inverse Gram matrix, in which a step of one is safe.
    # What can't be met is approached in tokens: that metric would give up much of a large domain for little of a small one.
    steps: list[np.ndarray] = []
    met = max_rate is None or bool((goal <= have * max_rate).all())
    if met:
        steps, total = fit(np.linalg.pinv(gram + np.eye(len(p)) * max(gram.trace(), 1.0) * 1e-9))
        met = np.abs(total - goal).max() <= MET * goal.sum()
    if not met and have.sum():
        steps, _ = fit(np.eye(len(p)) / np.linalg.eigvalsh(gram)[-1])
    rated = staged.withColumn("rate", F.round(_rate(steps, p, 1.0, max_rate), DECIMALS))
    chance = F.pmod(F.xxhash64(F.lit("mix"), "doc_id" if "doc_id" in carried else F.lit(0)), F.lit(1 << 30)) / (1 << 30)
    return rated.withColumn("copies", (F.floor("rate") + (chance < F.col("rate") - F.floor("rate")).cast("int")).cast("int"))


def domains_of(labels: DataFrame) -> DataFrame:
    """The table of labels as domains: ``toxic``, else ``clean`` or ``low`` by quality. A null is no label."""
    domain = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "clean").when(F.col("quality") == 0, "low")
    return labels.select("doc_id", domain.alias("domain"))


def keep_mixed(docs: DataFrame, labels: DataFrame, targets: dict[str, float], anchor: str, headroom: float) -> DataFrame:
    """The documents that the mix takes, each once; columns as they came."""
    a, b = temporary("a", "b")
    keyed = docs.withColumns({a: F.xxhash64("doc_id", "text"), b: F.hash("doc_id", "text")})  # never null
    mixed = mix(keyed, labels, targets, anchor=anchor, headroom=headroom, max_rate=1.0, carry=["doc_id", a, b])
    kept = mixed.where("copies > 0").select(a, b).distinct()
    # texts stay where they are while the keys of what is kept can be sent; beyond that they are joined
    return keyed.join(broadcast_within(kept, MAX_BROADCAST_KEPT), [a, b], "left_semi").select(*[f"`{c}`" for c in docs.columns])
