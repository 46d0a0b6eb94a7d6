"""Language identification of texts that may mix languages.

A model holds, for every language, how often each n-gram of letters occurs. A
text is a mixture: each of its words comes from one language, with the
likelihood of its n-grams there. Expectation-maximisation estimates the
proportions, and a language stays in the set only if the likelihood gains more
by it than a penalty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sightline.llm.common import small_batches

# Buckets that n-grams are hashed to; an n-gram is a letter with its two neighbours.
BUCKETS = 1 << 15

# The model is sent to every task; a table of more languages is refused.
MAX_LANGUAGES = 512

SMOOTHING = 0.5
ROUNDS = 30
TOLERANCE = 1e-3

# What a language must gain in log-likelihood to be in the set: a share of the words, and at least this much.
PENALTY_SHARE = 0.02
PENALTY_LEAST = 6.0

# Characters that are worked on at a time.
PIECE = 1 << 20

UNDECIDED = "und"

# Kinds of characters by code point; the planes behind these hold no letters or digits.
_PLANES = 0x40000
OTHER, LETTER, DIGIT = 0, 1, 2


def character_kinds() -> np.ndarray:
    return np.fromiter(
        (LETTER if chr(c).isalpha() else DIGIT if chr(c).isdigit() else OTHER for c in range(_PLANES)),
        dtype="int8",
        count=_PLANES,
    )


def word_grams(text: str, kinds: np.ndarray, with_digits: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of the n-gram around each letter of the words, and where each word begins among them.

    A word is a run of letters. Runs beside a digit are parts of numbers and
    keys rather than words, and count only ``with_digits``.
    """
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype="uint32")
    kind = np.zeros(len(codes) + 2, dtype="int8")
    kind[1:-1] = kinds[np.minimum(codes, _PLANES - 1)]
    is_letter = kind == LETTER
    starts = np.flatnonzero(is_letter[1:] & ~is_letter[:-1]) + 1
    ends = np.flatnonzero(is_letter[:-1] & ~is_letter[1:])
    if not with_digits:
        whole = (kind[starts - 1] != DIGIT) & (kind[ends + 1] != DIGIT)
        starts, ends = starts[whole], ends[whole]
    padded = np.zeros(len(kind), dtype="uint64")
    padded[1:-1] = codes
    padded[~is_letter] = 0
    mixed = padded[:-2] * np.uint64(0x9E3779B1) + padded[1:-1] * np.uint64(0x85EBCA77) + padded[2:] * np.uint64(0xC2B2AE3D)
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    grams = ((mixed >> np.uint64(40)) % np.uint64(BUCKETS)).astype("int64")
    lengths = ends - starts + 1
    first = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype("int64") if len(lengths) else lengths
    places = np.repeat(starts - 1 - first, lengths) + np.arange(lengths.sum())
    return grams[places], first


def pieces(text: str) -> Iterator[str]:
    """Parts of a long text, cut at blanks where there are some."""
    at = 0
    while at < len(text):
        end = min(len(text), at + PIECE)
        if end < len(text):
            blank = text.rfind(" ", at, end)
            end = blank if blank > at else end
        yield text[at:end]
        at = end


def train(labelled: DataFrame, text: str = "text", lang: str = "lang") -> tuple[list[str], np.ndarray]:
    """Languages in order, and the log-probability of each bucket in each: an array (buckets, languages).

    Reads all rows with a text and a language. A task sums its counts before
    they are shuffled, so what reaches the driver is one number per bucket and
    language.
    """
    small_batches(labelled.sparkSession)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kinds, sums = character_kinds(), {}
        for batch in batches:
            for name, body in zip(batch["lang"], batch["text"], strict=True):
                own = sums.setdefault(name, np.zeros(BUCKETS, dtype="int64"))
                for piece in pieces(body):
                    own += np.bincount(word_grams(piece, kinds)[0], minlength=BUCKETS)
        for name, own in sums.items():
            hit = np.flatnonzero(own)
            yield pd.DataFrame({"lang": name, "bucket": hit, "n": own[hit]})

    rows = labelled.select(F.col(lang).alias("lang"), F.col(text).alias("text")).where("lang IS NOT NULL AND text IS NOT NULL")
    counts = rows.mapInPandas(count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    names = rows.select("lang").distinct().orderBy("lang").limit(MAX_LANGUAGES + 1).toPandas()["lang"].tolist()
    if len(names) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    names.sort()
    table = np.full((BUCKETS, len(names)), SMOOTHING)
    if names:
        found = counts.toPandas()
        table[found["bucket"], pd.Index(names).get_indexer(found["lang"])] += found["n"]
    return names, np.log(table / table.sum(axis=0)).astype("float32")


def word_likelihoods(text: str, model: np.ndarray, kinds: np.ndarray, with_digits: bool = False) -> np.ndarray:
    """Log-likelihood of every word in every language: an array (words, languages)."""
    parts = []
    for piece in pieces(text):
        grams, starts = word_grams(piece, kinds, with_digits)
        if len(starts):
            parts.append(np.add.reduceat(model[grams], starts, axis=0))
    return np.concatenate(parts) if parts else np.zeros((0, model.shape[1]), dtype="float32")


def proportions(words: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, float]:
    """Shares of the languages in the words by expectation-maximisation, and the log-likelihood."""
    top = words.max(axis=1, keepdims=True)
    likely = np.exp(words - top).astype("float64")
    shares = np.full(words.shape[1], 1.0 / words.shape[1])
    for _ in range(rounds):
        joint = likely * shares
        total = joint.sum(axis=1, keepdims=True)
        new = (joint / total).mean(axis=0)
        done = np.abs(new - shares).max() < TOLERANCE
        shares = new
        if done:
            break
    value = np.log((likely * shares).sum(axis=1)).sum() + top.sum(dtype="float64")
    return shares, float(value)


def penalty(n_words: int) -> float:
    """What one more language costs."""
    return max(PENALTY_LEAST, PENALTY_SHARE * n_words) + 0.5 * np.log(max(1, n_words))


def mixture(words: np.ndarray) -> np.ndarray:
    """Shares of the languages; 0 for those outside the set of the best penalised likelihood.

    The set grows from the best single language by every other one, those with
    larger shares first, that raises the penalised likelihood, and gives up any
    whose loss raises it, until neither does.
    """
    n, width = words.shape
    alone = words.sum(axis=0, dtype="float64")
    chosen = [int(alone.argmax())]
    shares, best = np.array([1.0]), float(alone.max())
    cost = penalty(n)
    # No mixture beats the best language of every word.
    if width > 1 and float(words.max(axis=1).sum(dtype="float64")) - best > cost:
        ranked = [int(i) for i in np.argsort(-proportions(words)[0], kind="stable")]
        changed = True
        while changed:
            changed = False
            for other in ranked:
                if other not in chosen:
                    tried, value = proportions(words[:, [*chosen, other]])
                    if value - best > cost:
                        chosen, shares, best, changed = [*chosen, other], tried, value, True
            for other in list(chosen) if len(chosen) > 1 else []:
                rest = [i for i in chosen if i != other]
                if rest:
                    tried, value = proportions(words[:, rest])
                    if best - value < cost:
                        chosen, shares, best, changed = rest, tried, value, True
    out = np.zeros(width)
    out[chosen] = shares
    return out


VERDICT = "lang_pred string, score double, languages array<struct<lang:string,share:double>>"


def judged(text: str | None, names: list[str], model: np.ndarray, kinds: np.ndarray) -> tuple[str, float, list[dict]]:
    """Language, its share of the words, and all shares, of one text."""
    if not text or not names:
        return UNDECIDED, 0.0, []
    words = word_likelihoods(text, model, kinds)
    if len(words) == 0:
        words = word_likelihoods(text, model, kinds, with_digits=True)
    if len(words) == 0:
        return UNDECIDED, 0.0, []
    shares = mixture(words)
    order = [i for i in np.argsort(-shares, kind="stable") if shares[i] > 0]
    mixed = [{"lang": names[i], "share": min(1.0, float(shares[i]))} for i in order]
    return mixed[0]["lang"], mixed[0]["share"], mixed


def identify(spark: SparkSession, text: Column, names: list[str], model: np.ndarray) -> Column:
    """Struct (lang_pred, score, languages) of a text.

    ``score`` is the share of the words in that language and ``languages`` has
    all shares above 0. A text that is null or has no letter, and any text if
    nothing was learned, is ``und`` with score 0. Equal shares go to the first
    language by name. Only the text goes to Python, and a row is judged by it
    alone.
    """
    small_batches(spark)
    shared = spark.sparkContext.broadcast((names, model))

    @F.pandas_udf(VERDICT)
    def verdict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        langs, table = shared.value
        kinds = character_kinds()
        for batch in batches:
            found = [judged(text, langs, table, kinds) for text in batch]
            yield pd.DataFrame(found, columns=["lang_pred", "score", "languages"])

    return verdict(text)


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from training: crc32 of its id as text, modulo 4, is 2. A null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def learned(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """The model of the documents that are not held out."""
    return train(docs.where(~held_out(F.col("doc_id"))))


def documents_languages(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, languages) of every document."""
    verdict = identify(docs.sparkSession, F.col("text"), *learned(docs))
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), verdict.alias("verdict"))
    return rows.select("doc_id", "held_out", "verdict.*")


def keep_identified(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """Documents in a language, with the columns of ``docs``.

    Documents without a letter go, as do those in which no language has at
    least the share ``least`` of the words.
    """
    verdict = identify(docs.sparkSession, F.col("text"), *learned(docs))
    found = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), verdict.alias("verdict"))
    return found.where((F.col("verdict.lang_pred") != UNDECIDED) & (F.col("verdict.score") >= least)).select("row.*")
