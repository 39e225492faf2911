"""Language identification, word first, with backoff to character n-grams.

A known word adds its per-language log frequency.  An unknown one is looked up by its
longest known character n-grams: length 5 first, then 4, down to 1, and adds the mean of
their log frequencies.  Counting is a Spark aggregation over a bounded, documented sample
of labelled documents; the tables that come out have bounded size and go to the tasks with
the function, where each word's value is remembered.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import regex
from pyspark.sql import Column, DataFrame, Window, functions as F

from citewell.llm.common import map_batches

#: Documents of a language that are learned from, at most; chosen by a hash of their key.
PER_LANGUAGE = 1500
#: Known words of a language, and known n-grams of a length and language, at most.
WORDS, GRAMS = 20_000, 4_000
#: The longest n-gram that an unknown word backs off to.
LONGEST = 5

_WORD = r"\p{L}+"
_LETTERS = regex.compile(_WORD)
_REMEMBER = 150_000


@dataclass
class Model:
    languages: list[str]
    #: Log probabilities by language, for words, and for n-grams by length.
    words: dict[str, np.ndarray]
    grams: list[dict[str, np.ndarray]]
    #: What a letter adds that was never seen.
    unseen: np.ndarray

    def of_word(self, word: str) -> np.ndarray:
        known = self.words.get(word)
        if known is not None:
            return known
        framed = f"^{word}$"
        for n in range(LONGEST, 0, -1):
            table = self.grams[n]
            found = [table[g] for i in range(len(framed) - n + 1) if (g := framed[i : i + n]) in table]
            if found:
                return np.mean(found, axis=0)
        return self.unseen


def _table(counts: dict[str, dict[int, int]], languages: int) -> dict[str, np.ndarray]:
    """Log probabilities by language, half a count added; none has much less than one in all others."""
    totals = np.full(languages, 0.5 * max(len(counts), 1))
    dense = {}
    for key, by_language in counts.items():
        row = np.full(languages, 0.5)
        for language, n in by_language.items():
            row[language] += n
        dense[key] = row
        totals += row - 0.5
    return {key: np.log(row / totals) for key, row in dense.items()}


def fit(docs: DataFrame, column: str = "text", lang: str = "lang", key: str = "doc_id", per_language: int = PER_LANGUAGE) -> Model | None:
    """A model from labelled documents; rows without text or label teach nothing.  None if nothing is labelled.

    The sample is bounded by ``per_language`` rows of each language and the tables by ``WORDS``
    and ``GRAMS`` rows of each language, so what comes to the driver doesn't grow with the corpus.
    """
    labelled = docs.where(F.col(lang).isNotNull() & F.col(column).isNotNull()).select(
        F.col(key).alias("key"), F.col(lang).alias("lang")
    )
    picked = labelled.withColumn(
        "place", F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("key"), "key"))
    ).where(F.col("place") <= per_language).select("key").distinct()
    sample = docs.where(F.col(lang).isNotNull()).select(
        F.col(key).alias("key"), F.col(lang).alias("lang"), F.lower(F.col(column)).alias("text")
    ).join(F.broadcast(picked), "key", "left_semi")  # bounded: per_language keys of each language
    words = (
        sample.select("lang", F.explode(F.regexp_extract_all("text", F.lit(_WORD), F.lit(0))).alias("item"))
        .groupBy("lang", "item").agg(F.count("*").alias("n")).persist()
    )
    framed = F.concat(F.lit("^"), F.col("item"), F.lit("$"))

    def grams(n: int) -> Column:
        places = F.sequence(F.lit(1), F.greatest(F.length(framed) - n + 1, F.lit(1)))
        return F.transform(places, lambda i: F.struct(F.lit(n).alias("length"), F.substring(framed, i, F.lit(n)).alias("gram")))

    pieces = words.select("lang", "n", F.explode(F.flatten(F.array(*[grams(n) for n in range(1, LONGEST + 1)]))).alias("piece"))
    counted = words.select("lang", F.lit(0).alias("length"), "item", "n").unionByName(
        pieces.groupBy("lang", F.col("piece.length").alias("length"), F.col("piece.gram").alias("item")).agg(F.sum("n").alias("n"))
    )
    best = Window.partitionBy("lang", "length").orderBy(F.desc("n"), "item")
    rows = counted.withColumn("place", F.row_number().over(best)).where(
        F.col("place") <= F.when(F.col("length") == 0, WORDS).otherwise(GRAMS)
    ).select("lang", "length", "item", "n").collect()
    words.unpersist()
    languages = sorted({r.lang for r in rows})
    if not languages:
        return None
    place = {name: i for i, name in enumerate(languages)}
    counts: list[dict[str, dict[int, int]]] = [{} for _ in range(LONGEST + 1)]
    for r in rows:
        counts[r.length].setdefault(r.item, {})[place[r.lang]] = r.n
    tables = [_table(c, len(languages)) for c in counts]
    # A word that only one language has may be a name in another: no word decides alone.
    floor = {w: np.maximum(v, v.max() - 6.0) for w, v in tables[0].items()}
    return Model(languages, floor, tables, np.zeros(len(languages)))


def predict(docs: DataFrame, model: Model | None, keep: tuple[str, ...] = ("doc_id",), column: str = "text") -> DataFrame:
    """``keep``, lang_pred and score (0 to 1) of every row, from the text alone.

    Null, empty and letterless texts are ``und`` with score 0, as is every text without a model.
    Ties go to the language that comes first; repeated rows get equal answers.  The score is the
    chance of the language when the log frequencies of a word, averaged over the text, count as
    those of ``min(words, 20)`` words.
    """
    kinds = dict(docs.dtypes)
    schema = "".join(f"`{k}` {kinds[k]}, " for k in keep) + "lang_pred string, score double"
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def start():
        known = shared.value
        places: dict[str, int] = {}
        values = np.zeros((_REMEMBER, len(known.languages) if known else 0))

        def one(text: str | None) -> tuple[str, float]:
            found = _LETTERS.findall(text.lower()) if text and known else []
            if not found:
                return "und", 0.0
            # A text of more words than are remembered is added up in parts.
            total = np.zeros(len(known.languages))
            for at in range(0, len(found), _REMEMBER // 2):
                part = found[at : at + _REMEMBER // 2]
                if len(places) + len(part) > _REMEMBER:
                    places.clear()
                for word in part:
                    if word not in places:
                        values[len(places)] = known.of_word(word)
                        places[word] = len(places)
                total += values[[places[w] for w in part]].sum(axis=0)
            total *= min(len(found), 20) / len(found)
            chances = np.exp(total - total.max())
            best = int(chances.argmax())
            return known.languages[best], float(chances[best] / chances.sum())

        def made(*columns):
            return *columns[:-1], *(zip(*map(one, columns[-1])) if columns[-1] else ((), ()))

        return made

    return map_batches(docs.select(*keep, F.col(column)), schema, start)
