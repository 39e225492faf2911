"""Personal data: base patterns, and spans added by weak supervision.

Base spans (email, ip, card, phone) come from patterns with checks and always stay.  Candidates are other runs
of letters and digits that hold a digit, runs of six or more behind a private word with ``:`` or ``=``, and a known
given name with a capitalised word behind it.  Names of other shapes, postal addresses, and secrets of letters alone
without such a word in front are never candidates.  Five labelers - pattern, gazetteer, punctuation around,
composition, variety - vote private, not private, or abstain.  Expectation-maximisation over the counts of
vote patterns estimates each labeler's reliability and every pattern's chance of being
private; a logistic classifier of votes, length and kind is trained on those chances and
decides which candidates become spans.

Only DataFrame operations run over the texts.  What comes to the driver are counts by votes
and length class, a few thousand rows whatever the corpus.  A text's matches become rows and
running sums of their lengths give the places, so a text with very many matches stays linear.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from citewell.llm.common import whole
from citewell.session import staged

#: Base kinds in their order, then those of added spans.
KINDS = ("email", "ip", "card", "phone", "number", "id", "secret", "code", "name")
_KIND_FEATURES = ("number", "id", "secret", "name")
_CANDIDATE = "candidate"

#: Fixed values of the gazetteers: words before a private value, and before a plain one, and given names.
PRIVATE_WORDS = (
    "password passwd pwd passphrase token secret key apikey api_key access_key auth bearer credential login pin ssn iban account "
    "passport licence id_number phone tel telephone mobile cell fax call"
).split()
PLAIN_WORDS = (
    "version v release chapter page pages section figure table volume vol issue no number isbn issn doi line item step part "
    "year since until public license by nc sa cc http https port size width height score rank total count"
).split()
GIVEN_NAMES = (
    "James Mary John Patricia Robert Jennifer Michael Linda William Elizabeth David Barbara Richard Susan Joseph Jessica Thomas "
    "Sarah Charles Karen Daniel Nancy Matthew Lisa Anthony Sandra Paul Emily Andrew Anna Peter Maria Laura Kevin Julia Martin "
    "Carlos Juan Ana Luis Jose Pierre Marie Jean Sophie Hans Klaus Stefan Claudia Giulia Marco Luca Ivan Olga Elena Ahmed Fatima "
    "Mohammed Ali Priya Raj Wei Yuki Kenji"
).split()
_GIVEN = "(?:" + "|".join(GIVEN_NAMES) + ")"

# Possessive forms of the base patterns, which find the same matches in linear time: nothing
# that follows a possessive part could begin inside it.  (?:\G|(?<!x)) starts a match at the
# begin of a run of x or where the last match ended.
_PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    _CANDIDATE: (
        rf"(?=[A-Z])(?<![A-Za-z]){_GIVEN}(?:\x20[A-Z]\.)?\x20[A-Z][a-z]{{1,24}}+(?![A-Za-z])"
        rf"|(?<![A-Za-z0-9+/_-])(?<=[:=]\x20?[\"']?)(?<=(?i:{'|'.join(PRIVATE_WORDS)})\x20?[:=]\x20?[\"']?)[A-Za-z0-9+/_-]{{6,}}+"
        r"|\([0-9]{3}\)\x20?[0-9]{3}[\x20-][0-9]{4}(?![0-9])|(?<![0-9.])[0-9]{3}\.[0-9]{3}\.[0-9]{4}(?![0-9])"
        r"|(?<![A-Za-z0-9+/_-])[A-Za-z+/_-]*+[0-9][A-Za-z0-9+/_-]*+"
    ),
}
#: A text in which this is not found has no match.
_NEEDS = {
    "email": "@", "phone": "[+]", "ip": "[0-9]", "card": "[0-9]",
    _CANDIDATE: rf"[0-9]|[:=]\x20?[\"']?[A-Za-z+/_-]{{6}}|(?=[A-Z]){_GIVEN}\x20[A-Z]",
}

_LABELERS = ("pattern", "gazetteer", "around", "composition", "variety")
_LENGTHS = (4, 8, 12, 16, 20, 32)


def _matches(kind: str) -> Column:
    """kind, i, gap, before, hit, after for the matches of a pattern in ``text``: gap is what lies between the last match and this."""
    pattern = F.lit(_PATTERNS[kind])
    pieces, hits = F.split("text", _PATTERNS[kind], -1), F.regexp_extract_all("text", pattern, F.lit(0))
    # Texts without a needed character are not searched at all.
    searched = F.col("text").rlike(_NEEDS[kind])
    rows = F.transform(
        F.arrays_zip(pieces.alias("piece"), hits.alias("hit"), F.slice(pieces, F.lit(2), F.size(pieces)).alias("next")),
        lambda x, i: F.struct(
            F.lit(kind).alias("kind"), i.alias("i"), F.length(x["piece"]).alias("gap"),
            F.when(F.lit(kind == _CANDIDATE), F.right(x["piece"], F.lit(24))).alias("before"), x["hit"].alias("hit"),
            F.when(F.lit(kind == _CANDIDATE), F.left(x["next"], F.lit(2))).alias("after"),
        ),
    )
    return F.when(searched, F.filter(rows, lambda x: x["hit"].isNotNull()))


def _luhn(digits: str) -> Column:
    return F.expr(
        f"aggregate(sequence(1, length({digits})), 0, (s, i) -> s + if(i % 2 = 1, cast(substring(reverse({digits}), i, 1) as int), "
        f"2 * cast(substring(reverse({digits}), i, 1) as int) - if(cast(substring(reverse({digits}), i, 1) as int) > 4, 9, 0))) % 10 = 0"
    )


def _valid() -> Column:
    """Whether a base match passes the checks of its kind."""
    digits = F.length(F.col("digits"))
    parts = F.expr("forall(split(hit, '[.]'), p -> length(ltrim('0', p)) <= 3 and cast(concat('0', right(ltrim('0', p), 3)) as int) <= 255)")
    return (
        F.when(F.col("kind") == "ip", parts)
        .when(F.col("kind") == "card", F.when(digits.between(14, 19), _luhn("digits")).otherwise(False))
        .when(F.col("kind") == "phone", digits.between(10, 15))
        .otherwise(True)
    )


def _vote(private: Column, plain: Column) -> Column:
    return F.when(private, 1).when(plain, -1).otherwise(0)


def _votes() -> dict[str, Column]:
    """A candidate's votes: 1 private, -1 not, 0 abstains."""
    hit, size = F.col("hit"), F.length("hit")
    word = F.regexp_extract(F.lower("before"), r"([a-z_]+)[\x20]*[=:]?[\x20]*[\"']?$", 1)
    letters, digits = hit.rlike("[A-Za-z]"), hit.rlike("[0-9]")
    given = hit.rlike(rf"^{_GIVEN}\x20")
    kinds = F.array_size(F.array_distinct(F.split(hit, "")))
    return {
        "pattern": _vote(
            hit.rlike(
                r"^AKIA[0-9A-Z]{16}$|^[0-9a-f]{16,}$|^(?:sk|pk|gh[a-z]|xox[a-z])[-_][A-Za-z0-9_-]{10,}$|^[0-9]{3}-[0-9]{2}-[0-9]{4}$"
                r"|^\([0-9]{3}\)|^[0-9]{3}[-.][0-9]{3}[-.][0-9]{4}$|^[A-Z][a-z]+(?:\x20[A-Z]\.)?\x20[A-Z][a-z]+$"
            ) & ~hit.rlike("^[0-9]{16,}$"),
            hit.rlike(r"^[0-9]{1,6}[A-Za-z]{0,2}$"),
        ),
        "gazetteer": _vote(given | word.isin(PRIVATE_WORDS), word.isin(PLAIN_WORDS)),
        "around": _vote(
            F.col("before").rlike(r"[=:][\x20]*[\"']?$|(?:Mr|Mrs|Ms|Dr|Prof|Dear)\.?\x20$"), F.col("before").rlike(r"[$€£#][\x20]?$") | F.col("after").rlike("^[%°.,]?[%°0-9]")
        ),
        "composition": _vote(letters & digits & (size >= 16), (size < 8) & ~given | ~letters & ~hit.rlike("[^0-9]")),
        "variety": _vote(letters & (kinds >= 9), kinds <= 4),
    }


@dataclass
class Classifier:
    """What the labelers are worth, and the logistic weights by feature."""

    reliability: dict[str, dict[int, tuple[float, float]]]
    weights: dict[str, float]

    def logit(self) -> Column:
        return F.expr(" + ".join(f"if({name}, {weight!r}D, 0D)" for name, weight in sorted(self.weights.items())))


def _features() -> list[str]:
    """SQL conditions that are the classifier's features."""
    votes = [f"{name} = {value}" for name in _LABELERS for value in (-1, 1)]
    return ["true", *votes, *[f"size >= {n}" for n in range(1, len(_LENGTHS) + 1)], *[f"kind = '{k}'" for k in _KIND_FEATURES]]


def train(counts: list[tuple[tuple[int, ...], int, str, int]], rounds: int = 60) -> Classifier | None:
    """From (votes, length class, kind, how many): reliabilities by expectation-maximisation, then the classifier.

    A labeler's votes are taken as independent given whether the span is private.  The start is
    the majority of the votes.  None without candidates.
    """
    if not counts:
        return None
    votes, many = np.array([c[0] for c in counts]), np.array([c[3] for c in counts], float)
    chance = 1 / (1 + np.exp(-2.0 * votes.sum(axis=1)))
    for _ in range(rounds):
        share = float(np.clip((chance * many).sum() / many.sum(), 1e-4, 1 - 1e-4))
        log_odds = np.full(len(counts), np.log(share / (1 - share)))
        worth = {}
        for k, name in enumerate(_LABELERS):
            worth[name] = {}
            for value in (-1, 0, 1):
                is_it = votes[:, k] == value
                yes = ((chance * many)[is_it].sum() + 1) / ((chance * many).sum() + 3)
                no = (((1 - chance) * many)[is_it].sum() + 1) / (((1 - chance) * many).sum() + 3)
                if value:  # a labeler is never taken to mean the opposite of its vote
                    yes, no = (max(yes, no), min(yes, no)) if value > 0 else (min(yes, no), max(yes, no))
                    log_odds[is_it] += np.log(yes / no)
                worth[name][value] = (float(yes), float(no))
        chance = 1 / (1 + np.exp(-np.clip(log_odds, -30, 30)))
    names = _features()
    rows = np.array([
        [1.0, *[float(v[k] == value) for k in range(len(_LABELERS)) for value in (-1, 1)],
         *[float(size >= n) for n in range(1, len(_LENGTHS) + 1)], *[float(kind == k) for k in _KIND_FEATURES]]
        for v, size, kind, _ in counts
    ])
    # Newton steps of a logistic regression with soft labels and a small penalty.
    weights, scale = np.zeros(len(names)), many / many.sum() * min(many.sum(), 1e5)
    for _ in range(30):
        fitted = 1 / (1 + np.exp(-np.clip(rows @ weights, -30, 30)))
        slope = rows.T @ (scale * (chance - fitted)) - 0.1 * weights
        curve = (rows * (scale * fitted * (1 - fitted))[:, None]).T @ rows + 0.1 * np.eye(len(names))
        step = np.linalg.solve(curve, slope)
        weights = weights + step * min(1.0, 5.0 / max(float(np.abs(step).max()), 1e-9))
    return Classifier(worth, {name: round(float(w), 6) for name, w in zip(names, weights)})


def find(docs: DataFrame, key: str = "doc_id", column: str = "text") -> tuple[DataFrame, DataFrame]:
    """Rows and spans of ``docs``.

    Rows: row, doc_id, one for each row of ``docs``.  Spans: row, kind, start, end (code points, end
    exclusive), base, chance.  Null counts as empty, which has no span; repeated rows have
    their own spans; an empty table has none.  Other columns are left out.
    """
    searched = docs.select(F.col(key).alias("doc_id"), whole(column).alias("text")).select(
        F.monotonically_increasing_id().alias("row"), "doc_id",
        *[_matches(kind).alias(f"m_{kind}") for kind in _PATTERNS],
    )
    none = F.expr("filter(array(named_struct('kind', '', 'i', 0, 'gap', 0, 'before', '', 'hit', '', 'after', '')), x -> false)")
    all_matches = F.concat(*[F.coalesce(f"m_{kind}", none) for kind in _PATTERNS])
    rows = staged(searched.select("row", "doc_id", all_matches.alias("matches")), "pii-matches")
    matches = rows.select("row", F.explode("matches").alias("m")).select("row", "m.*")
    order = Window.partitionBy("row", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap").cast("long") + F.length("hit")).over(order)
    placed = (
        matches.withColumn("end", end).withColumn("start", F.col("end") - F.length("hit"))
        .withColumn("digits", F.regexp_replace("hit", "[^0-9]", ""))
        .withColumn("base", F.col("kind") != _CANDIDATE)
        .where(F.when(F.col("base"), _valid()).otherwise(True))
    )
    # Candidates that touch a base span are not candidates.
    is_base, so_far = F.col("base"), (Window.unboundedPreceding, 0)
    upwards = Window.partitionBy("row").orderBy("start").rangeBetween(*so_far)
    downwards = Window.partitionBy("row").orderBy(F.desc("start")).rangeBetween(*so_far)
    last_end = F.max(F.when(is_base, F.col("end"))).over(upwards)
    next_start = F.min(F.when(is_base, F.col("start"))).over(downwards)
    free = placed.withColumn("__last", last_end).withColumn("__next", next_start).where(
        is_base | ((F.coalesce("__last", F.lit(-1)) <= F.col("start")) & (F.coalesce("__next", F.col("end")) >= F.col("end")))
    )
    for name, vote in _votes().items():
        free = free.withColumn(name, F.when(~is_base, vote))
    hit = F.col("hit")
    sort = (
        F.when(is_base, F.col("kind")).when(hit.rlike(r"^[0-9]{3}-[0-9]{2}-[0-9]{4}$"), "id")
        .when(hit.rlike(r"^\([0-9]{3}\)|^[0-9]{3}[-.][0-9]{3}[-.][0-9]{4}$"), "number")
        .when(hit.contains(" ") & hit.rlike("^[A-Z]"), "name")
        .when(~hit.rlike("[0-9]") | hit.rlike("[A-Za-z]") & (F.length("hit") >= 16), "secret").otherwise("code")
    )
    size = sum((F.when(F.length("hit") >= n, 1).otherwise(0) for n in _LENGTHS), F.lit(0))
    voted = staged(
        free.withColumn("size", size).withColumn("kind", sort)
        .select("row", "kind", "start", "end", "base", "size", *_LABELERS), "pii-votes"
    )
    counts = voted.where("not base").groupBy(*_LABELERS, "size", "kind").count().orderBy(*_LABELERS, "size", "kind").collect()
    model = train([(tuple(r[name] for name in _LABELERS), r["size"], r["kind"], r["count"]) for r in counts])
    logit = model.logit() if model else F.lit(-1.0)
    chance = F.when(F.col("base"), 1.0).otherwise(1 / (1 + F.exp(-logit)))
    spans = voted.withColumn("chance", chance).where("base or chance >= 0.5")
    return rows.select("row", "doc_id"), spans.select("row", "kind", "start", "end", "base", "chance")


def spans_of(docs: DataFrame, key: str = "doc_id", column: str = "text") -> DataFrame:
    """``key`` and spans of every row: structs of start, place of the kind in ``KINDS``, end, kind, base, in that order.

    Null and empty texts have an empty list, repeated rows a list each; an empty table gives an
    empty one, and other columns are left out.
    """
    rows, spans = find(docs, key, column)
    place = F.array_position(F.lit(list(KINDS)), F.col("kind"))
    span = F.struct("start", place.alias("place"), "end", "kind", "base")
    lists = spans.groupBy("row").agg(F.sort_array(F.collect_list(span)).alias("spans"))
    empty = F.expr("filter(array(named_struct('start', 0L, 'place', 0L, 'end', 0L, 'kind', '', 'base', true)), x -> false)")
    joined = rows.join(lists.withColumnRenamed("row", "__row"), F.col("row") == F.col("__row"), "left")
    return joined.select(F.col("doc_id").alias(key), F.coalesce("spans", empty).alias("spans"))
