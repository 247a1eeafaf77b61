"""Quality rules: decision lists learned by sequential covering.

Statistics of whole texts (words, symbols, repeated lines and windows, ...)
are counted in one Arrow pass without a shuffle.  A list of rules for
"reject" is learned from labelled documents: each rule is a conjunction of
thresholds on ratios of the statistics, grown on two thirds of the rows that
no earlier rule covers (best FOIL gain first) and pruned on the other third
(last conditions go while that raises (p - n) / (p + n)).  A rule enters the
list only if its precision on both parts reaches ``min_precision``; the first
that does not ends the search.  The list is applied as an ordered Spark
``CASE WHEN``, so scoring needs neither Python nor a model file.

Bound: the rules are learned on at most ``max_labelled`` labelled documents,
those with the smallest hash of their id; nothing else is sampled.

Edge cases: a null or empty text has zero counts and fails the base check;
ratios with an empty denominator are 0; without usable labels the list is
empty and keeps all that pass the base check; of several labels for one id the
lowest counts; input columns named like an output do not clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notelab.llm import bytewords as bw
from notelab.llm.common import fresh_name

SYMBOLS = bw.byte_set("#*$%&|<>")
UPPER = bw.byte_set("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
DIGIT = bw.byte_set("0123456789")
CHARACTER = (np.arange(256) & 0xC0) != 0x80  # first bytes of code points
WINDOW = 8

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_digits",
          "n_distinct_words", "n_lines"]
#: feature: numerator and denominator
FEATURES = {
    "words": ("n_words", None),
    "word_length": ("word_chars", "n_words"),
    "symbol_share": ("n_symbols", "word_chars"),
    "dup_line_share": ("n_dup_lines", "n_lines"),
    "repeat_share": ("n_repeat_words", "n_words"),
    "upper_share": ("n_upper", "word_chars"),
    "digit_share": ("n_digits", "word_chars"),
    "distinct_share": ("n_distinct_words", "n_words"),
    "line_words": ("n_words", "n_lines"),
}


def _repeats(h: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Masks of those equal to another one of the same text, and of all but
    one of each such set."""
    key = bw.mix(h + bw.mix(owner.astype(np.uint64)))
    order = np.argsort(key)
    same = key[order[1:]] == key[order[:-1]]
    any_, later = np.zeros(len(h), bool), np.zeros(len(h), bool)
    any_[order[1:][same]] = any_[order[:-1][same]] = True
    later[order[1:][same]] = True
    return any_, later


def slab_counts(slab: bw.Slab) -> list[np.ndarray]:
    """The columns of ``COUNTS`` for the texts of a slab."""
    s, e, first = slab.spans(bw.NOT_SPACE)
    h = slab.prefix_hash()
    with np.errstate(over="ignore"):
        words, owner = slab.hashes(h, s, e), bw.owners(first)
        pos, window = bw.windows(words, first, WINDOW)
        twice, _ = _repeats(window, owner[pos])
        repeated = bw.covered(len(words), pos[twice], WINDOW)
        _, word_again = _repeats(words, owner)
        ls, le, l_first = slab.lines()
        filled = np.searchsorted(s, ls) < np.searchsorted(s, le)
        full = np.flatnonzero(filled)
        line_owner = bw.owners(l_first)
        _, again = _repeats(slab.hashes(h, ls[full], le[full]), line_owner[full])
    dup = np.zeros(len(ls), bool)
    dup[full[again]] = True

    def bytes_in(members: np.ndarray) -> np.ndarray:
        return bw.per_text(members[slab.data], slab.offsets)

    return [np.diff(first), bytes_in(bw.NOT_SPACE & CHARACTER), bytes_in(SYMBOLS), bw.per_text(dup, l_first),
            bw.per_text(repeated, first), bytes_in(UPPER), bytes_in(DIGIT),
            np.diff(first) - bw.per_text(word_again, first), bw.per_text(filled, l_first)]


def _count(text_at: int, kept: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [slab_counts(x) for x in bw.slabs(batch.column(text_at))]
            columns = [np.concatenate(x) for x in zip(*parts, strict=True)] if parts else [np.zeros(0, np.int64)] * len(COUNTS)
            stats = pa.StructArray.from_arrays([pa.array(x.astype(np.int64)) for x in columns], names=COUNTS)
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in kept), stats],
                                             names=[f"c{i}" for i in range(len(kept) + 1)])

    return run


def with_counts(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> tuple[DataFrame, str]:
    """The columns ``keep`` (all by default) and a struct of ``COUNTS``, whose
    name is returned too."""
    keep = docs.columns if keep is None else keep
    name = fresh_name(docs, "counts")
    types = dict(docs.dtypes)
    schema = ", ".join([*(f"c{i} {types[c]}" for i, c in enumerate(keep)),
                        f"c{len(keep)} struct<{', '.join(f'{c}: long' for c in COUNTS)}>"])
    run = _count(docs.columns.index(text_col), [docs.columns.index(c) for c in keep])
    return docs.mapInArrow(run, schema).toDF(*keep, name), name


def base_failed(counts: Column) -> Column:
    return (counts["n_words"] < 20) | (100 * counts["n_repeat_words"] > 30 * counts["n_words"])


@dataclass(frozen=True)
class Condition:
    feature: str
    at_least: bool
    threshold: float

    def column(self, counts: Column) -> Column:
        over, under = FEATURES[self.feature]
        x = counts[over].cast("double")
        if under:
            x = F.when(counts[under] > 0, x / counts[under]).otherwise(F.lit(0.0))
        return x >= F.lit(self.threshold) if self.at_least else x < F.lit(self.threshold)

    def mask(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return x[self.feature] >= self.threshold if self.at_least else x[self.feature] < self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.at_least else '<'} {self.threshold:.6g}"


Rule = list[Condition]


def features(counts: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    out = {}
    for name, (over, under) in FEATURES.items():
        x = counts[over].astype(float)
        out[name] = x if under is None else np.divide(x, counts[under], out=np.zeros(len(x)), where=counts[under] > 0)
    return out


def covers(rule: Rule, x: dict[str, np.ndarray], n: int) -> np.ndarray:
    mask = np.ones(n, bool)
    for c in rule:
        mask &= c.mask(x)
    return mask


def _best_condition(x: dict[str, np.ndarray], y: np.ndarray, inside: np.ndarray) -> tuple[float, Condition | None]:
    p0, n0 = int((y & inside).sum()), int((~y & inside).sum())
    best: tuple[float, Condition | None] = (1e-9, None)
    for name, column in x.items():
        v, t = column[inside], y[inside]
        order = np.argsort(v, kind="stable")
        v, t = v[order], t[order]
        cut = np.flatnonzero(v[1:] > v[:-1]) + 1  # rows from cut on have at least v[cut]
        if not len(cut):
            continue
        p_low = np.cumsum(t)[cut - 1]
        for at_least, p, n in ((True, p0 - p_low, (len(v) - cut) - (p0 - p_low)), (False, p_low, cut - p_low)):
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where(p > 0, p * (np.log2(p / (p + n)) - np.log2(p0 / (p0 + n0))), 0)
            i = int(np.argmax(gain))
            if gain[i] > best[0]:
                best = (float(gain[i]), Condition(name, at_least, float((v[cut[i]] + v[cut[i] - 1]) / 2)))
    return best


def _worth(mask: np.ndarray, y: np.ndarray) -> float:
    p, n = int((mask & y).sum()), int((mask & ~y).sum())
    return (p - n) / (p + n) if p + n else -1.0


def learn(x: dict[str, np.ndarray], y: np.ndarray, min_precision: float = 0.95, min_cover: int = 5,
          max_conditions: int = 4, seed: int = 0) -> list[Rule]:
    """Ordered rules for ``y``; x: feature values by name."""
    rules: list[Rule] = []
    left = np.ones(len(y), bool)
    rng = np.random.default_rng(seed)
    while (y & left).sum() >= min_cover:
        part = rng.integers(0, 3, len(y))
        grow, prune = left & (part > 0), left & (part == 0)
        rule: Rule = []
        inside = grow.copy()
        while len(rule) < max_conditions and (inside & ~y).any():
            _, condition = _best_condition(x, y, inside)
            if condition is None:
                break
            rule.append(condition)
            inside &= condition.mask(x)
        if not rule:
            break
        prefixes = [rule[:k] for k in range(len(rule), 0, -1)]
        rule = max(prefixes, key=lambda r: (_worth(covers(r, x, len(y)) & prune, y), len(r)))
        hit = covers(rule, x, len(y))

        def precision(rows: np.ndarray, hit: np.ndarray = hit) -> float:
            return (hit & rows & y).sum() / max(1, (hit & rows).sum())

        if (hit & left & y).sum() < min_cover or precision(grow) < min_precision or precision(prune) < min_precision:
            break
        rules.append(rule)
        left &= ~hit
    return rules


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", max_labelled: int = 20000, **options) -> list[Rule]:
    """Learn "reject" (label 0) from at most ``max_labelled`` documents."""
    sample = (
        labels.filter(F.col(label_col).isNotNull() & F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").cast("long").alias("label_id")).agg(F.min(label_col).alias("label"))
        .orderBy(F.xxhash64("label_id"), "label_id").limit(max_labelled))
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    narrow = narrow.join(F.broadcast(sample), narrow.doc_id == sample.label_id).select("doc_id", "label", "text")
    counted, name = with_counts(narrow, keep=["doc_id", "label"])
    # repeated rows of an id count once, which keeps the bound
    rows = (counted.groupBy("doc_id").agg(F.max("label").alias("label"), F.max(name).alias(name))
            .select("doc_id", "label", f"{name}.*").toArrow().to_pandas().sort_values("doc_id"))
    if not len(rows):
        return []
    counts = {c: rows[c].to_numpy() for c in COUNTS}
    failed = (counts["n_words"] < 20) | (100 * counts["n_repeat_words"] > 30 * counts["n_words"])
    counts = {c: v[~failed] for c, v in counts.items()}  # the base check needs no rule
    return learn(features(counts), (rows["label"].to_numpy() == 0)[~failed], **options)


def first_rule(rules: list[Rule], counts: Column) -> Column:
    """Number of the first rule that rejects, null if none does."""
    out = None
    for i, rule in enumerate(rules):
        test = rule[0].column(counts)
        for c in rule[1:]:
            test = test & c.column(counts)
        out = F.when(test, F.lit(i)) if out is None else out.when(test, F.lit(i))
    return F.lit(None).cast("int") if out is None else out


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Per document: doc_id, counts, base_failed, kept, rule (that rejects)."""
    rules = fit(docs, labels, id_col, text_col, **options)
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    counted, name = with_counts(narrow, keep=["doc_id"])
    c = F.col(name)
    failed, rule = base_failed(c), first_rule(rules, c)
    text = F.element_at(F.array(*[F.lit(" and ".join(map(str, r))) for r in rules]), rule + 1) if rules else F.lit(None).cast("string")
    return counted.select("doc_id", f"{name}.*", failed.alias("base_failed"), (~failed & rule.isNull()).alias("kept"),
                          F.when(rule.isNotNull(), text).alias("rule"))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents that pass the base check and every rule, columns as given."""
    rules = fit(docs, labels, id_col, text_col, **options)
    counted, name = with_counts(docs, text_col)
    c = F.col(name)
    return counted.filter(~base_failed(c) & first_rule(rules, c).isNull()).drop(name)
