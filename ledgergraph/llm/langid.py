"""Language ID by multilingual mixture inference.

A document is read as a mixture: each of its letter trigrams comes from one of the learned
languages, in unknown proportions. Expectation-maximisation over the trigram likelihoods
estimates the proportions; starting from the best single language, a further language joins the
set only if it raises the log-likelihood by more than its penalty (half the log of the number of
trigrams per free proportion, times ``penalty``). The prediction is the language with the
largest proportion and the score is that proportion, discounted by how far the trigrams are from
the learned ones.

Training counts hashed trigrams per language on Spark, over at most ``max_train`` labelled rows
(a hash sample per language of the rows that may be learned from, whole texts: the bound is shared
among the languages, and one with fewer rows than its share keeps them all, so the languages learned
are the same at every size); the counts are ``BUCKETS`` numbers per language. Prediction reads every whole text in Arrow batches; a long text
is counted piece by piece. Neither lang, source nor doc_id is an input of a prediction.

Defined results: null text or one without letters: ``und``, score 0; no learned language: ``und``
for all; texts too short for a trigram count with word boundaries as part of them; an empty table
gives no rows; extra columns never clash; repeated rows get the same prediction.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgergraph.llm.common import held_out, pick, read

BUCKETS = 1 << 16
MAX_LANGUAGES = 100     # rows of at most BUCKETS sums each that may come to the driver; more is an error
PIECE = 1 << 18        # code points counted at a time

_LETTER: np.ndarray | None = None


def _letters() -> np.ndarray:
    """Which code points are letters (built once per Python worker)."""
    global _LETTER
    if _LETTER is None:
        _LETTER = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return _LETTER


def trigram_counts(text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
    """(buckets, counts) of the letter trigrams of a text; None if it has no letter. Runs of
    other characters count as one word boundary."""
    if not text:
        return None
    letter, total, seen = _letters(), None, False
    for at in range(0, len(text), PIECE):
        # two code points of overlap; lower-casing is per piece
        part = text[max(0, at - 2):at + PIECE].lower()
        codes = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), "<u4")
        is_letter = letter[codes]
        if not is_letter.any():
            continue
        seen = True
        codes = np.where(is_letter, codes, 32).astype(np.uint32)
        keep = np.ones(len(codes), bool)
        keep[1:] = is_letter[1:] | is_letter[:-1]
        codes = np.concatenate(([32], codes[keep], [32])).astype(np.uint32)
        grams = ((codes[:-2] * np.uint32(0x9E3779B1)) ^ (codes[1:-1] * np.uint32(0x85EBCA77))
                 ^ (codes[2:] * np.uint32(0xC2B2AE3D)))
        counts = np.bincount((grams * np.uint32(0x27D4EB2F)) >> np.uint32(16), minlength=BUCKETS)
        total = counts if total is None else total + counts
    if not seen:
        return None
    at = np.flatnonzero(total)
    return at, total[at]


def fair_share(sizes: list[int], most: int) -> float:
    """The number of rows up to which each language may be learned from, so that ``most`` rows are: what
    small languages leave of their share goes to the others."""
    left = float(most)
    for i, n in enumerate(sorted(sizes)):
        share = left / (len(sizes) - i)
        if n > share:
            return share
        left -= n
    return float(max(sizes, default=0))


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          max_train: int = 20_000) -> tuple[list[str], np.ndarray]:
    """(languages, trigram likelihoods [BUCKETS, languages]) from rows with a lang that are not held
    out. ``max_train`` bounds the rows learned from in expectation (a seeded hash sample per language)."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"),
                       F.col(text_col).cast("string").alias("text"))
    rows = rows.filter(F.col("lang").isNotNull() & ~held_out(F.col("id")))
    def sizes(rows: DataFrame) -> dict[str, int]:
        found = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).limit(MAX_LANGUAGES + 1).collect()
        return {r["lang"]: r["n"] for r in found}

    by_lang = sizes(rows)
    if len(by_lang) > MAX_LANGUAGES:      # labels of texts without letters are no languages
        rows = rows.filter(F.col("text").rlike(r"\p{L}"))
        by_lang = sizes(rows)
        if len(by_lang) > MAX_LANGUAGES:
            raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if sum(by_lang.values()) > max_train:
        share = fair_share(list(by_lang.values()), max_train)
        rate = F.create_map(*[F.lit(x) for lang, n in sorted(by_lang.items()) for x in (lang, min(1.0, share / n))])
        draw = F.pmod(F.xxhash64(F.col("id"), F.lit(10)), F.lit(1 << 40)) / float(1 << 40)
        rows = rows.filter(draw < F.element_at(rate, F.col("lang")))

    def counted(batches):
        sums: dict[str, np.ndarray] = {}
        for pdf in batches:
            for lang, text in zip(pdf["lang"], pdf["text"]):
                got = trigram_counts(text)
                if got is not None:
                    sums.setdefault(lang, np.zeros(BUCKETS, np.int64))[got[0]] += got[1]
        for lang, counts in sums.items():
            at = np.flatnonzero(counts)
            yield pd.DataFrame({"lang": lang, "bucket": at.astype(np.int32), "n": counts[at]})

    # counts are added up per language and bucket; a language comes here as one row of sums
    sums = (rows.select("lang", "text").mapInPandas(counted, "lang string, bucket int, n long")
            .groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
            .groupBy("lang").agg(F.collect_list("bucket").alias("at"), F.collect_list("n").alias("n"))
            .limit(MAX_LANGUAGES + 1).collect())
    if len(sums) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not sums:
        return [], np.zeros((BUCKETS, 0), np.float32)
    names, counts = sorted(r["lang"] for r in sums), np.zeros((BUCKETS, len(sums)))
    for r in sums:
        counts[r["at"], names.index(r["lang"])] = r["n"]
    like = (counts + 0.05) / (counts.sum(axis=0) + 0.05 * BUCKETS)
    return names, like.astype(np.float32)


def _mix(p: np.ndarray, n: np.ndarray, rounds: int = 40, close: float = 1e-3) -> tuple[np.ndarray, float]:
    """Proportions by expectation-maximisation and the log-likelihood they reach."""
    total = n.sum()
    share = np.full(p.shape[1], 1.0 / p.shape[1], np.float32)
    for _ in range(rounds):
        weighted = p * share
        weighted *= (n / weighted.sum(axis=1))[:, None]
        new = weighted.sum(axis=0) / total
        moved = np.abs(new - share).max()
        share = new
        if moved < close:
            break
    return share, float((n * np.log(p @ share)).sum())


def infer(counts: tuple[np.ndarray, np.ndarray], like: np.ndarray, penalty: float = 4.0) -> tuple[dict[int, float], float]:
    """({language index: proportion}, fit): the language set of one document by penalised likelihood.
    ``fit`` is the mean trigram likelihood against a uniform one, squashed to 0..1."""
    at, n = counts
    p, n = like[at], n.astype(np.float32)
    single = n @ np.log(p)
    first = int(single.argmax())
    chosen, best, share = [first], float(single[first]), np.ones(1, np.float32)
    cost = penalty * 0.5 * np.log(n.sum() + 1)
    rest = [i for i in np.argsort(-single) if i != first]
    while rest:
        # likeliest gain: the language that explains most trigrams better than the set does
        now = p[:, chosen] @ share
        gain = [float((n * np.log(0.9 * now + 0.1 * p[:, i])).sum()) for i in rest]
        i = rest[int(np.argmax(gain))]
        if max(gain) <= best:
            break
        new_share, reached = _mix(p[:, chosen + [i]], n)
        if reached - best <= cost:
            break
        chosen, best, share = chosen + [i], reached, new_share
        rest.remove(i)
    fit = best / float(n.sum()) + np.log(BUCKETS)
    return dict(zip(chosen, share.tolist())), float(1 / (1 + np.exp(-fit)))


RESULT = "lang_pred string, score double, languages string"


def identify(docs: DataFrame, model: tuple[list[str], np.ndarray], text_col: str = "text",
             penalty: float = 4.0) -> DataFrame:
    """``docs`` as the struct ``row`` with ``lang_pred``, ``score`` and ``languages``, the language set
    with proportions."""
    names, like = model
    shared = docs.sparkSession.sparkContext.broadcast(like)      # BUCKETS x languages, at most 26 MB

    @F.pandas_udf(RESULT)
    def predict(texts: pd.Series) -> pd.DataFrame:
        like, out = shared.value, []
        for text in texts:
            counts = trigram_counts(text) if names else None
            if counts is None:
                out.append(("und", 0.0, ""))
                continue
            mix, fit = infer(counts, like, penalty)
            best = max(mix, key=lambda i: (mix[i], -i))
            said = ",".join(f"{names[i]}:{mix[i]:.3f}" for i in sorted(mix, key=lambda i: (-mix[i], i)))
            out.append((names[best], min(1.0, mix[best] * fit), said))
        return pd.DataFrame(out, columns=["lang_pred", "score", "languages"])

    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    return (docs.select(row.alias("row")).withColumn("p", predict(F.col(f"row.`{text_col}`").cast("string")))
            .select("row", "p.*"))


def keep_identified(docs: DataFrame, max_train: int = 20_000) -> DataFrame:
    """The rows of ``docs`` in a learned language; those predicted ``und`` go."""
    found = identify(docs, train(docs, max_train=max_train))
    return found.filter("lang_pred != 'und'").select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def query(spark, sf_dir):
    """op10: predicted language of every document."""
    docs = pick(read(spark, sf_dir, "documents"), ["doc_id", "text", "lang"])
    found = identify(docs.select("doc_id", "text"), train(docs))
    return found.select(F.col("row.doc_id").alias("doc_id"), held_out(F.col("row.doc_id")).alias("held_out"),
                        "lang_pred", "score", "languages")
