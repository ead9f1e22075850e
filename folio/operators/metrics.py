"""Per-pair metrics: NED, sentence BLEU (13a, exp smoothing, effective order),
Markdown structure F1 (13 types, macro average) and greedy embedding match.

``score_pairs`` scores every pair in its row (edit distance, n-gram counts and element
counts are Arrow-batched calls per pair), so it adds no exchange to the plan.
"""

from __future__ import annotations

from collections import Counter

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from folio.functions.distance import distance_and_lengths
from folio.functions.bleu import MAX_ORDER, text_matches
from folio.functions.markdown import ELEMENT_TYPES, with_elements
from folio.functions.text import col, nfc, normalise, stage
from folio.session import bounded_batches

# Score direction and range of each metric (used for ranking models).
METRIC_META = (
    ("ned", 0.0, 1.0, False),
    ("bleu", 0.0, 100.0, True),
    ("struct_f1", 0.0, 1.0, True),
    ("bert_f1", 0.0, 1.0, True),
)


def ned(ref_n, hyp_n, engine: str = "bitparallel") -> Column:
    """Normalised edit distance of two metric-normalised texts, rounded to 6 places.

    ``engine="bitparallel"`` (default) uses the Arrow-batched bit-vector distance,
    ``"jvm"`` Spark's built-in ``levenshtein``; both are exact.
    """
    r, h = col(ref_n), col(hyp_n)
    if engine == "bitparallel":
        d = distance_and_lengths(r, h)
        return ned_of(d[0], d[1], d[2])
    return ned_of(F.when(r == h, F.lit(0)).otherwise(F.levenshtein(r, h)), F.length(r), F.length(h))


def ned_of(dist: Column, lr: Column, lh: Column) -> Column:
    return (F.when((lr == 0) & (lh == 0), F.lit(0.0))
            .when((lr == 0) | (lh == 0), F.lit(1.0))
            .otherwise(F.bround(dist / F.greatest(lr, lh, F.lit(1)), 6)))


def similarity(ned_col) -> Column:
    return F.bround(1.0 - col(ned_col), 6)


def bleu_from_counts(correct, total_of, ref_len, hyp_len) -> Column:
    """Sentence BLEU from clipped n-gram matches. ``correct`` is a list of 4 columns;
    totals are the hypothesis n-gram counts; exp smoothing, effective order."""
    rl, hl = col(ref_len), col(hyp_len)
    totals = [total_of(n) for n in range(1, MAX_ORDER + 1)]
    bp = (F.when(hl >= rl, F.lit(1.0))
          .when(hl > 0, F.exp(F.lit(1.0) - rl / F.greatest(hl, F.lit(1))))
          .otherwise(F.lit(0.0)))
    eff = F.least(hl, F.lit(MAX_ORDER))
    zeros = F.lit(0)
    logsum = F.lit(0.0)
    for n in range(1, MAX_ORDER + 1):
        c, t = correct[n - 1], totals[n - 1]
        zeros = zeros + F.when(c == 0, 1).otherwise(0)
        p = F.when(c == 0, F.lit(100.0) / (F.pow(F.lit(2.0), zeros) * F.greatest(t, F.lit(1)))) \
             .otherwise(F.lit(100.0) * c / F.greatest(t, F.lit(1)))
        logsum = logsum + F.when(F.lit(n) <= eff, F.log(p)).otherwise(F.lit(0.0))
    any_match = F.greatest(*correct) > 0
    return F.when(any_match, bp * F.exp(logsum / F.greatest(eff, F.lit(1)))).otherwise(F.lit(0.0))


def f1_of(tp, ref_cnt, hyp_cnt) -> Column:
    """F1 of one element type: both empty 1.0, one empty 0.0, else 2PR/(P+R) rounded to 6."""
    tp, rc, hc = col(tp), col(ref_cnt), col(hyp_cnt)
    p = tp / F.greatest(hc, F.lit(1))
    r = tp / F.greatest(rc, F.lit(1))
    return (F.when((rc == 0) & (hc == 0), F.lit(1.0))
            .when((rc == 0) | (hc == 0), F.lit(0.0))
            .when(p + r == 0, F.lit(0.0))
            .otherwise(F.bround(F.lit(2.0) * p * r / (p + r), 6)))


def prepare_pairs(pairs: DataFrame, keys, ref: str = "ref", hyp: str = "hyp") -> DataFrame:
    """Pair keys, NFC texts (null: empty) and their metric-normalised forms. One Arrow
    call composes both sides."""
    bounded_batches(pairs.sparkSession)
    both = pairs.select(*keys, composed(ref).alias("_ref"), composed(hyp).alias("_hyp"))
    return stage(both, [*keys, "_ref", "_hyp"], _rn=normalise("_ref"), _hn=normalise("_hyp"))


def _counts(ref, hyp) -> list[int]:
    """Overlap, reference and prediction counts of every element type, in order."""
    at = {t: 3 * i for i, t in enumerate(ELEMENT_TYPES)}
    out = [0] * (3 * len(at))
    r, h = Counter(ref), Counter(hyp)
    for e, n in r.items():
        i = at[e.partition("\t")[0]]
        out[i] += min(n, h.get(e, 0))
        out[i + 1] += n
    for e, n in h.items():
        out[at[e.partition("\t")[0]] + 2] += n
    return out


def _flat(elems: str) -> Column:
    """Elements as lines of type-tab-token; normalised tokens hold no line break."""
    return F.array_join(F.transform(elems, lambda e: F.concat(e["type"], F.lit("\t"), e["token"])), "\n")


@F.pandas_udf(ArrayType(LongType()))
def type_counts(ref: pd.Series, hyp: pd.Series) -> pd.Series:
    """Multiset overlap of two texts of type-tab-token lines, three counts a type (Arrow-batched, per pair)."""
    return pd.Series([_counts(*[x.split("\n") if x else [] for x in side]) for side in zip(ref, hyp)])


def score_pairs(pairs: DataFrame, keys, ref: str = "ref", hyp: str = "hyp",
                detail: bool = False, with_counts: bool = False) -> DataFrame:
    """Per pair: ned, similarity, bleu, struct_f1 (+ one F1 column per element type
    with ``detail``; + BLEU n-gram counts with ``with_counts``).

    Every pair is scored in its row: no text, token or element leaves it, so there is
    no exchange here. Callers spread the pairs before (see ``evaluate.eval_scores``)."""
    keys = list(keys)
    base = prepare_pairs(pairs, keys, ref, hyp)
    base = with_elements(with_elements(base, "_ref", "_er"), "_hyp", "_eh")
    base = base.select(*keys, ned("_rn", "_hn").alias("ned"), text_matches("_rn", "_hn").alias("_cm"),
                       type_counts(_flat("_er"), _flat("_eh")).alias("_tc"))
    base = base.withColumns({"ref_len": F.col("_cm")[MAX_ORDER], "hyp_len": F.col("_cm")[MAX_ORDER + 1]})
    correct = [F.col("_cm")[n] for n in range(MAX_ORDER)]

    def total_of(n):
        return F.greatest(F.col("hyp_len") - (n - 1), F.lit(0))

    # one expression for all types, folded over the array: 13 copies of it would be too large to compile
    per_type = F.transform(F.sequence(F.lit(0), F.lit(len(ELEMENT_TYPES) - 1)), lambda i: F.struct(
        f1_of(*[F.get("_tc", 3 * i + k) for k in range(3)]).alias("f1"), (F.get("_tc", 3 * i + 1) > 0).alias("present")))
    base = stage(base, base.columns, _f1=per_type)
    # the macro average adds the types present in the reference in their fixed order
    total = F.aggregate("_f1", F.struct(F.lit(0.0).alias("f1"), F.lit(0).alias("n")), lambda acc, x: F.when(
        x["present"], F.struct((acc["f1"] + x["f1"]).alias("f1"), (acc["n"] + 1).alias("n"))).otherwise(acc))
    base = stage(base, base.columns, _macro=total)
    macro = F.when(F.col("_macro.n") > 0, F.bround(F.col("_macro.f1") / F.greatest("_macro.n", F.lit(1)), 6)).otherwise(F.lit(1.0))
    out = [*keys, "ned", similarity("ned").alias("similarity"),
           bleu_from_counts(correct, total_of, "ref_len", "hyp_len").alias("bleu"),
           macro.alias("struct_f1")]
    if detail:
        out += [F.col("_f1")[i]["f1"].alias(f"f1_{t}") for i, t in enumerate(ELEMENT_TYPES)]
    if with_counts:
        out += [F.col("ref_len").cast("bigint").alias("ref_len"), F.col("hyp_len").cast("bigint").alias("hyp_len")]
        out += [correct[n - 1].alias(f"correct_{n}") for n in range(1, MAX_ORDER + 1)]
        out += [total_of(n).cast("bigint").alias(f"total_{n}") for n in range(1, MAX_ORDER + 1)]
    return base.select(*out)


def element_table(pairs: DataFrame, keys, ref: str = "ref", hyp: str = "hyp") -> DataFrame:
    """Long element multiset: keys, side, type, token, cnt."""
    bounded_batches(pairs.sparkSession)
    return count_elements(pairs.select(*keys, composed(ref).alias("_ref"), composed(hyp).alias("_hyp")), keys)


def composed(text) -> Column:
    """A text as the metrics take it: NFC, null as empty."""
    return nfc(F.coalesce(text, F.lit("")))


def count_elements(both: DataFrame, keys) -> DataFrame:
    """``element_table`` of composed texts ``_ref`` and ``_hyp``. No Python call: rows that are partitioned by (some of) the
    keys are counted where they are."""
    keys = list(keys)
    both = with_elements(with_elements(both, "_ref", "_er"), "_hyp", "_eh")
    x = both.select(*keys, F.explode_outer(F.concat(
        F.transform("_er", lambda e: F.struct(F.lit("ref").alias("side"), e["type"].alias("type"),
                                                      e["token"].alias("token"))),
        F.transform("_eh", lambda e: F.struct(F.lit("hyp").alias("side"), e["type"].alias("type"),
                                                      e["token"].alias("token"))),
    )).alias("e")).filter(F.col("e").isNotNull()).select(*keys, "e.side", "e.type", "e.token")
    return x.groupBy(*keys, "side", "type", "token").agg(F.count("*").alias("cnt"))


def greedy_embedding_match(token_vec: DataFrame, pair_keys, side: str = "side", vec: str = "vec",
                           pairs: DataFrame | None = None, block: int = 512) -> DataFrame:
    """Embedding-match F1 per pair from token vectors (``side`` is 'ref' or 'hyp').

    Precision = mean over hyp tokens of the best ref match, recall the reverse,
    F1 = 2PR/(P+R) rounded to 6; both sides empty 1.0, one side empty 0.0. Similarities
    are made in blocks of ``block`` x ``block`` tokens, so a long pair needs no token-by-token matrix.
    With ``pairs`` (the pair keys) pairs without any token are scored too."""
    import numpy as np

    keys = list(pair_keys)
    schema = ", ".join(f"{k} {t}" for k, t in token_vec.select(*keys).dtypes) + \
        ", n_ref bigint, n_hyp bigint, precision double, recall double, bert_f1 double"

    def score(pdf: pd.DataFrame) -> pd.DataFrame:
        out = {k: [pdf[k].iloc[0]] for k in keys}
        is_ref = (pdf[side] == "ref").to_numpy()
        a, b = (np.array(pdf[vec][m].tolist(), dtype=np.float64) for m in (is_ref, ~is_ref))
        if not len(a) or not len(b):
            p = r = f = 0.0
        else:
            a, b = (m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-12) for m in (a, b))
            best_r, best_h = np.full(len(a), -np.inf), np.full(len(b), -np.inf)
            for i in range(0, len(b), block):
                for j in range(0, len(a), block):
                    sim = b[i:i + block] @ a[j:j + block].T
                    np.maximum(best_h[i:i + block], sim.max(axis=1), out=best_h[i:i + block])
                    np.maximum(best_r[j:j + block], sim.max(axis=0), out=best_r[j:j + block])
            p, r = float(best_h.mean()), float(best_r.mean())
            f = 0.0 if p + r == 0 else round(2 * p * r / (p + r), 6)
        out.update(n_ref=[len(a)], n_hyp=[len(b)], precision=[p], recall=[r], bert_f1=[f])
        return pd.DataFrame(out)

    found = token_vec.groupBy(*keys).applyInPandas(score, schema)
    if pairs is None:
        return found
    found = pairs.select(*keys).join(found, keys, "left")
    none = F.col("n_ref").isNull()
    return found.select(*keys, *[F.when(none, 0).otherwise(F.col(c)).cast("bigint").alias(c) for c in ("n_ref", "n_hyp")],
                        *[F.when(none, 1.0).otherwise(F.col(c)).alias(c) for c in ("precision", "recall", "bert_f1")])


def corpus_embedding_score(scores: DataFrame, group=()) -> DataFrame:
    """Corpus embedding score: mean pair F1 to 4 places; no pair -> 0."""
    return scores.groupBy(*group).agg(F.count("*").alias("n_pairs"),
                                      F.coalesce(F.bround(F.avg("bert_f1"), 4), F.lit(0.0)).alias("corpus_bert_f1"))
