"""Personal data by weak supervision, in DataFrame functions alone.

Candidates are what exact patterns find, whether or not their checks hold, and what looser patterns find
besides. Five labelers vote for, against or not at all on each candidate: the pattern, its arithmetic, a
gazetteer, the words around and the characters at its edges. Expectation-maximisation over the counted
vote patterns (Dawid and Skene, 1979) estimates how reliable each labeler is for each kind, and so how
likely each candidate is real. With that as soft labels a naive Bayes classifier of spans is trained on
votes, shape and context; it decides on the loose candidates. Exact spans always stay.

Votes and features are counted in one aggregation whose number of groups does not depend on the data, so
all that reaches the driver is a table of bounded size; the model goes back as literals.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tellerloom.functions.names import ref

KINDS = ("email", "ip", "card", "phone")

# The exact patterns. Guards and possessive quantifiers keep them linear in the length of
# a text without changing what is matched.
EXACT = {
    "email": r"[A-Za-z0-9._%+-](?:(?<![A-Za-z0-9._%+-]{2})|(?<=\G[\s\S]))[A-Za-z0-9._%+-]*+"
    r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"[0-9](?<![0-9]{2})[0-9]*+\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
# Loose patterns: written-out signs in e-mail addresses, the long form of an IP address, a card number
# with other separators or one digit less, a phone number without its country.
LOOSE = {
    "email": r"[A-Za-z0-9._%+-](?<![A-Za-z0-9._%+-]{2})[A-Za-z0-9._%+-]{0,63}+"
    r" ?(?:\(at\)|\[at\]|\{at\}) ?[A-Za-z0-9-]++(?: ?(?:\.|\(dot\)|\[dot\]|\{dot\}) ?[A-Za-z0-9-]++)++",
    "ip": r"[0-9A-Fa-f](?<![0-9A-Fa-f:]{2})[0-9A-Fa-f]{0,3}+(?::[0-9A-Fa-f]{1,4}+){7}(?![0-9A-Fa-f:])",
    "card": r"[0-9](?<![0-9][./ -]?[0-9])[0-9]{3}[./][0-9]{4}[./][0-9]{4}[./][0-9]{1,4}(?![0-9])",
    "phone": r"[(0-9](?<![0-9+(.-][ ]?[(0-9])(?:(?<=\()[0-9]{3}\) ?|(?<=[0-9])[0-9]{2}[ .-])"
    r"[0-9]{3}[ .-][0-9]{4}(?![0-9])",
}
# A text without this has no match of the pattern, which is far cheaper to see.
HINTS = {
    ("email", True): ("@",),
    ("phone", True): ("+",),
    ("email", False): ("at)", "at]", "at}"),
    ("ip", False): (":",),
}

# The gazetteers.
TOP_LEVELS = """com org net edu gov mil int info biz io co me tv de fr es it uk us ca au nl be ch at se no
dk fi pl pt ie eu jp cn in br mx ru""".split()
CALLING_CODES = """1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61
62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98 351 352 353 354 358 380 420 421 971 972""".split()
ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[47]|30[0-5]|3[68]|6011|65|35)"
WORDS_FOR = {
    "email": "mail email contact write reach address courriel correo kontakt",
    "ip": "ip host server client address from addr adresse",
    "card": "card visa mastercard amex credit payment carte tarjeta karte",
    "phone": "phone tel telephone call mobile fax cell telefon téléphone móvil contact",
}
WORDS_AGAINST = "token key id isbn hash secret serial version sha order ref build"
WORD_CHARACTERS = 24
# Matches of one text whose places are summed up together.
BLOCK = 128
# Code points of a text that spans are replaced in at once.
STRETCH = 4096

LABELERS = 5
FOR, NONE, AGAINST = 2, 1, 0
# Before any data, a labeler is taken to be right about so often, with the weight of so many candidates.
# The two that repeat a kind's definition start higher.
PRIOR_RIGHT = (0.95, 0.95, 0.7, 0.7, 0.7)
PRIOR_WEIGHT = 20.0
ROUNDS = 60
# Features of the span classifier are hashed into so many values each.
VALUES = 64
SMOOTHING = 0.5
THRESHOLD = 0.9


def _matches(text: Column, pattern: str, hints: tuple[str, ...]) -> Column:
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    if not hints:
        return found
    seen = F.contains(text, F.lit(hints[0]))
    for hint in hints[1:]:
        seen = seen | F.contains(text, F.lit(hint))
    return F.when(seen, found).otherwise(F.array().cast("array<string>"))


def _around(parts: Column, matches: Column) -> Column:
    """Matches with what stands around them, from the text between the matches."""
    count = F.size(matches)
    found = F.arrays_zip(
        F.slice(parts, 1, count).alias("before"),
        matches.alias("span"),
        F.slice(parts, 2, count).alias("after"),
    )

    def one(match: Column) -> Column:
        return F.struct(
            match["span"].alias("span"),
            F.right(match["before"], F.lit(WORD_CHARACTERS)).alias("left"),
            F.left(match["after"], F.lit(WORD_CHARACTERS)).alias("right"),
            F.length(match["before"]).cast("long").alias("gap"),
            F.length(match["span"]).cast("long").alias("length"),
        )

    empty = F.array().cast(
        "array<struct<span:string,left:string,right:string,gap:bigint,length:bigint>>"
    )
    return F.when(count > 0, F.transform(found, one)).otherwise(empty)


def _running(
    steps: Column, joined: Callable[[Column, Column], Column] = lambda total, x: total + x
) -> Column:
    """Running sums, or what else is joined from zero on, of an array that is not empty.

    Appending to an array copies it, so sums run inside blocks and over blocks, and a text with very
    many matches stays affordable.
    """
    longs = F.array().cast("array<bigint>")

    def sums(values: Column, start: Column, after: bool) -> Column:
        def step(state: Column, x: Column) -> Column:
            at = joined(state["at"], x)
            return F.struct(
                at.alias("at"),
                F.array_append(state["sums"], at if after else state["at"]).alias("sums"),
            )

        first = F.struct(start.alias("at"), longs.alias("sums"))
        return F.aggregate(values, first, step, lambda state: state["sums"])

    zero = F.lit(0).cast("long")
    starts = F.sequence(F.lit(1), F.size(steps), F.lit(BLOCK))
    blocks = F.transform(starts, lambda at: F.slice(steps, at, BLOCK))
    totals = F.transform(blocks, lambda b: F.aggregate(b, zero, joined))
    offsets = sums(totals, zero, after=False)
    return F.flatten(F.zip_with(blocks, offsets, lambda b, at: sums(b, at, after=True)))


def _placed(around: Column) -> Column:
    """Matches with ``start`` and ``end`` in code points."""
    ends = _running(F.transform(around, lambda m: m["gap"] + m["length"]))

    def one(match: Column, end: Column) -> Column:
        return F.struct(
            (end - match["length"]).alias("start"),
            end.alias("end"),
            *[match[name].alias(name) for name in ("span", "left", "right")],
        )

    empty = F.array().cast(
        "array<struct<start:bigint,end:bigint,span:string,left:string,right:string>>"
    )
    return F.when(F.size(around) > 0, F.zip_with(around, ends, one)).otherwise(empty)


def _digits(span: Column) -> Column:
    return F.regexp_replace(span, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether a string of up to 19 digits passes the Luhn sum; of others only the length is looked at."""
    count = F.length(digits)

    def weighed(i: Column) -> Column:
        digit = F.ascii(F.substring(digits, (count - i).cast("int"), F.lit(1))) - 48
        return F.when(i % 2 == 0, digit).otherwise(digit * 2 - F.when(digit > 4, 9).otherwise(0))

    places = F.sequence(F.lit(0), F.least(count, F.lit(19)) - 1)
    total = F.aggregate(F.transform(places, weighed), F.lit(0), lambda a, x: a + x)
    return F.when(count > 0, total % 10 == 0).otherwise(False)


OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"


def valid(kind: str, span: Column) -> Column:
    """Whether a match of the exact pattern passes the check of its kind."""
    if kind == "ip":
        return F.rlike(span, F.lit(rf"^{OCTET}(?:\.{OCTET}){{3}}$"))
    if kind == "card":
        digits = _digits(span)
        return F.when(F.length(digits).between(14, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(_digits(span)).between(10, 15)
    return F.lit(True)


def _vote(for_it: Column, against: Column) -> Column:
    return F.when(against, AGAINST).when(for_it, FOR).otherwise(NONE)


def _sum_holds(kind: str, span: Column) -> Column:
    if kind == "email":
        top = F.regexp_extract(span, r"([A-Za-z0-9-]+)[)\]}]?$", 1)
        return F.rlike(top, F.lit("^[A-Za-z]{2,24}$"))
    if kind == "ip":
        return valid("ip", span) | F.contains(span, F.lit(":"))
    if kind == "card":
        return F.length(_digits(span)).between(13, 19) & _luhn(_digits(span))
    return F.length(_digits(span)).between(10, 15)


def _known(kind: str, span: Column) -> Column:
    if kind == "email":
        return F.lower(F.regexp_extract(span, r"([A-Za-z0-9-]+)$", 1)).isin(TOP_LEVELS)
    if kind == "ip":
        return ~F.rlike(span, F.lit(r"^0*(?:0|22[4-9]|2[3-9][0-9])\."))
    if kind == "card":
        return F.rlike(_digits(span), F.lit(ISSUERS))
    codes = "|".join(CALLING_CODES)
    return F.rlike(_digits(span), F.lit(rf"^(?:{codes})[0-9]{{6,}}$"))


def _words(text: Column) -> Column:
    return F.split(F.lower(F.regexp_replace(text, r"[^\p{L}]+", " ")), " ")


def _votes(kind: str, exact: bool, one: Column) -> Column:
    """The five votes on a match."""
    span = one["span"]
    words = F.array_union(_words(one["left"]), _words(one["right"]))
    known_for = F.arrays_overlap(words, F.array(*map(F.lit, WORDS_FOR[kind].split())))
    known_against = F.arrays_overlap(words, F.array(*map(F.lit, WORDS_AGAINST.split())))
    pattern = (
        F.when(valid(kind, span), FOR).otherwise(AGAINST) if exact else F.lit(NONE)
    )
    total = F.when(_sum_holds(kind, span), FOR).otherwise(AGAINST)
    known = F.when(_known(kind, span), FOR).otherwise(NONE if kind == "phone" else AGAINST)
    edge_against = F.rlike(one["left"], F.lit(r"[\p{L}\p{N}_=\"/]$")) | F.rlike(
        one["right"], F.lit(r"^[\p{L}\p{N}_=\"/]")
    )
    edge_for = F.rlike(one["left"], F.lit(r"(?:^|[\s(<|:,;])$"))
    return F.array(
        pattern,
        total,
        known,
        _vote(known_for & ~known_against, known_against & ~known_for),
        _vote(edge_for, edge_against),
    )


def _pattern_number(votes: Column) -> Column:
    return F.aggregate(votes, F.lit(0), lambda number, vote: number * 3 + vote)


def _features(one: Column, votes: Column) -> Column:
    """Vote pattern, shape, length, word before and word after, each as a small number."""
    shape = F.regexp_replace(
        F.regexp_replace(F.regexp_replace(one["span"], "[0-9]", "9"), "[A-Z]", "A"), "[a-z]+", "a"
    )
    before = F.lower(F.regexp_extract(one["left"], r"(\p{L}+)\P{L}*$", 1))
    after = F.lower(F.regexp_extract(one["right"], r"^\P{L}*(\p{L}+)", 1))
    hashed = [F.pmod(F.xxhash64(x), F.lit(VALUES)).cast("int") for x in (shape, before, after)]
    length = F.least(F.length(one["span"]), F.lit(VALUES - 1))
    return F.array(_pattern_number(votes), hashed[0], length, hashed[1], hashed[2])


FEATURE_VALUES = (3**LABELERS, VALUES, VALUES, VALUES, VALUES)


def _candidates(kind: str, exact: bool, placed: Column) -> Column:
    """Placed matches with the validity of exact ones and the features of all."""

    def one(match: Column) -> Column:
        return F.struct(
            match["start"].alias("start"),
            match["end"].alias("end"),
            (valid(kind, match["span"]) if exact else F.lit(False)).alias("base"),
            _features(match, _votes(kind, exact, match)).alias("features"),
        )

    if kind == "card":
        # Other runs of digits are numbers of all sorts and teach nothing about cards.
        placed = F.filter(placed, lambda m: F.length(_digits(m["span"])).between(13, 20))
    return F.transform(placed, one)


@dataclass(frozen=True)
class Model:
    """Per kind: the log odds before any feature, and for each feature the log odds of its values."""

    prior: dict[str, float]
    weights: dict[str, tuple[tuple[float, ...], ...]]

    def probability(self, kind: str, features: Column) -> Column:
        odds = F.lit(self.prior[kind])
        for number, weights in enumerate(self.weights[kind]):
            odds = odds + F.element_at(F.lit(list(weights)), features[number] + 1)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-odds))


def _overlaps(one: Column, others: Column) -> Column:
    return F.exists(others, lambda o: (o["start"] < one["end"]) & (one["start"] < o["end"]))


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and, for each kind, its ``<kind>`` and ``<kind>_loose`` candidates in the whole text.

    A candidate has ``start`` and ``end`` (code points, end exclusive), ``base`` (an exact span that
    passes its check) and ``features``. Loose ones that overlap a base span of any kind are left out. A
    null text is empty. One row for each of ``docs``, a null id stays null, repeated rows stay repeated,
    other columns are not looked at, and an empty table gives an empty result.
    """
    return _found(docs.select(F.col(id_col).cast("long").alias("doc_id"), _text(text_col)), "doc_id")


def candidates_in_rows(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Like ``candidates``, with the whole row as a struct ``row`` in place of the id, whatever its names."""
    whole = F.struct(*[ref(name) for name in docs.columns])
    return _found(docs.select(whole.alias("row"), _text(text_col)), "row")


def _text(text_col: str) -> Column:
    return F.coalesce(ref(text_col).cast("string"), F.lit("")).alias("text")


def _found(found: DataFrame, kept: str) -> DataFrame:
    """The candidates in ``text``, beside the column ``kept``."""
    sets = [(k, exact) for exact in (True, False) for k in KINDS]
    name = {(k, exact): k if exact else f"{k}_loose" for k, exact in sets}
    pattern = {(k, exact): (EXACT if exact else LOOSE)[k] for k, exact in sets}
    found = found.withColumns(
        {f"m_{name[s]}": _matches(F.col("text"), pattern[s], HINTS.get(s, ())) for s in sets}
    )
    parts = {
        f"p_{name[s]}": F.when(
            F.size(f"m_{name[s]}") > 0, F.split("text", pattern[s], -1)
        ).otherwise(F.array().cast("array<string>"))
        for s in sets
    }
    found = found.withColumns(parts).drop("text")
    found = found.select(
        kept, *[_around(F.col(f"p_{n}"), F.col(f"m_{n}")).alias(n) for n in name.values()]
    )
    found = found.select(kept, *[_placed(F.col(n)).alias(n) for n in name.values()])
    found = found.select(kept, *[_candidates(*s, F.col(n)).alias(n) for s, n in name.items()])
    base = F.flatten(F.array(*[F.filter(F.col(k), lambda c: c["base"]) for k in KINDS]))
    found = found.withColumn("base", base)
    return found.select(
        kept,
        *KINDS,
        *[
            F.filter(F.col(f"{k}_loose"), lambda c: ~_overlaps(c, F.col("base"))).alias(f"{k}_loose")
            for k in KINDS
        ],
    )


def _reliabilities(counts: dict[int, float]) -> tuple[float, dict[int, float]]:
    """Share of real candidates, and how likely each vote pattern is real, by EM over the counts."""
    patterns = {
        n: [n // 3 ** (LABELERS - 1 - i) % 3 for i in range(LABELERS)] for n in counts
    }

    def odds(table: list, share: float, votes: list[int]) -> float:
        log = math.log(share / (1 - share))
        for i, vote in enumerate(votes):
            if vote != NONE:
                log += math.log(table[i][1][vote] / table[i][0][vote])
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, log))))

    # table[labeler][real][vote]: how often a vote is cast, abstentions apart.
    table = [
        [{FOR: 1 - right, AGAINST: right}, {FOR: right, AGAINST: 1 - right}]
        for right in PRIOR_RIGHT
    ]
    share = 0.5
    total = sum(counts.values())
    real = {n: odds(table, share, votes) for n, votes in patterns.items()}
    for _ in range(ROUNDS):
        share = (1 + sum(counts[n] * real[n] for n in counts)) / (2 + total)
        for i, right in enumerate(PRIOR_RIGHT):
            for y in (0, 1):
                cast = {
                    FOR: PRIOR_WEIGHT * (right if y else 1 - right),
                    AGAINST: PRIOR_WEIGHT * (1 - right if y else right),
                }
                for n, votes in patterns.items():
                    if votes[i] != NONE:
                        cast[votes[i]] += counts[n] * (real[n] if y else 1 - real[n])
                both = cast[FOR] + cast[AGAINST]
                table[i][y] = {vote: value / both for vote, value in cast.items()}
        real = {n: odds(table, share, votes) for n, votes in patterns.items()}
    return share, real


def fit(found: DataFrame) -> Model:
    """The span classifier from the candidates of all documents.

    One aggregation counts how often each feature value goes with each vote pattern of a kind: at most
    4 * 243 * (243 + 4 * 64) groups, whatever the number of documents. A kind without candidates gets a
    classifier that adds nothing, so do all kinds of an empty table. Repeated rows count as often.
    """

    def numbered(number: int) -> Callable[[Column], Column]:
        return lambda c: F.struct(F.lit(number).alias("kind"), c["features"].alias("features"))

    every = F.flatten(
        F.array(
            *[
                F.transform(F.concat(F.col(kind), F.col(f"{kind}_loose")), numbered(number))
                for number, kind in enumerate(KINDS)
            ]
        )
    )
    counted = (
        found.select(F.explode(every).alias("c"))
        .select("c.kind", F.col("c.features")[0].alias("pattern"), F.posexplode("c.features"))
        .groupBy("kind", "pattern", "pos", "col")
        .agg(F.count(F.lit(1)).alias("n"))
        .collect()
    )
    by_kind: dict[int, list] = defaultdict(list)
    for row in counted:
        by_kind[row["kind"]].append(row)
    prior, weights = {}, {}
    for number, kind in enumerate(KINDS):
        rows = by_kind[number]
        counts = {row["pattern"]: float(row["n"]) for row in rows if row["pos"] == 0}
        share, real = _reliabilities(counts)
        prior[kind] = math.log(share / (1 - share)) if counts else -30.0
        tables = []
        for position, size in enumerate(FEATURE_VALUES):
            table = [[SMOOTHING, SMOOTHING] for _ in range(size)]
            for row in rows:
                if row["pos"] == position:
                    p = real[row["pattern"]]
                    table[row["col"]][1] += row["n"] * p
                    table[row["col"]][0] += row["n"] * (1 - p)
            sums = [sum(t[y] for t in table) for y in (0, 1)]
            tables.append(tuple(math.log(t[1] / sums[1]) - math.log(t[0] / sums[0]) for t in table))
        weights[kind] = tuple(tables)
    return Model(prior, weights)


def spans(found: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``base`` and ``all``: sorted arrays of (start, number of the kind, end, kind).

    ``all`` has the base spans and the loose candidates that the classifier takes for real. One row for
    each of ``found``; of what ``candidates_in_rows`` found, with ``row`` in place of the id.
    """

    def plain(number: int, kind: str) -> Callable[[Column], Column]:
        return lambda c: F.struct(
            c["start"].alias("start"),
            F.lit(number).alias("number"),
            c["end"].alias("end"),
            F.lit(kind).alias("kind"),
        )

    def likely(kind: str) -> Callable[[Column], Column]:
        return lambda c: model.probability(kind, c["features"]) >= THRESHOLD

    base, added = [], []
    for number, kind in enumerate(KINDS):
        base.append(F.transform(F.filter(F.col(kind), lambda c: c["base"]), plain(number, kind)))
        chosen = F.filter(F.col(f"{kind}_loose"), likely(kind))
        added.append(F.transform(chosen, plain(number, kind)))
    return found.select(
        "row" if "row" in found.columns else "doc_id",
        F.array_sort(F.flatten(F.array(*base))).alias("base"),
        F.array_sort(F.flatten(F.array(*base, *added))).alias("all"),
    )


def listed(column: str) -> Column:
    """Spans as kind:start:end, joined by commas."""
    return F.array_join(
        F.transform(
            column,
            lambda s: F.concat_ws(
                ":", s["kind"], s["start"].cast("string"), s["end"].cast("string")
            ),
        ),
        ",",
    )


def _regions(placed: Column) -> Column:
    """Overlapping spans as one region, named by the first: start, end, kind, and the end of the one before.

    ``placed`` is sorted by start and not empty.
    """
    ends = _running(F.transform(placed, lambda s: s["end"]), lambda most, end: F.greatest(most, end))
    zero = F.array(F.lit(0).cast("long"))
    before = F.concat(zero, F.slice(ends, F.lit(1), F.size(ends) - 1))

    def opening(span: Column, end: Column) -> Column:
        return F.struct(span["start"].alias("start"), span["kind"].alias("kind"), end.alias("before"))

    opened = F.filter(
        F.zip_with(placed, before, opening), lambda s: s["start"] >= s["before"]
    )
    # A region ends where the one after it finds the last end before.
    reached = F.concat(
        F.transform(F.slice(opened, F.lit(2), F.size(opened)), lambda s: s["before"]),
        F.array(F.array_max(ends)),
    )

    def whole(opened: Column, end: Column) -> Column:
        return F.struct(*[opened[n].alias(n) for n in ("start", "kind", "before")], end.alias("end"))

    return F.zip_with(opened, reached, whole)


def _replaced(stretch: Column, within: Column) -> Column:
    """A stretch of a text with the names of the kinds in place of the regions ``within`` it."""
    low = within["low"]

    def beside(place: Column) -> Column:
        return F.greatest(place - low, F.lit(0).cast("long")).cast("int")

    def piece(region: Column) -> Column:
        after = beside(region["before"])
        plain = F.substring(stretch, after + 1, F.greatest(F.lit(0), beside(region["start"]) - after))
        name = F.concat(F.lit("<"), F.upper(region["kind"]), F.lit(">"))
        return F.concat(plain, F.when(region["start"] >= low, name).otherwise(""))

    last = F.element_at(within["regions"], -1)["end"]
    rest = F.substring(stretch, beside(last) + 1, F.lit(STRETCH))
    pieces = F.array_join(F.transform(within["regions"], piece), "")
    return F.when(F.size(within["regions"]) > 0, F.concat(pieces, rest)).otherwise(stretch)


def masked_rows(found: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows that ``candidates_in_rows`` has looked at, every span replaced by its kind, like ``<EMAIL>``.

    The spans are those that ``spans`` gives. Of spans that overlap, all they cover is replaced by the kind
    of the one that starts first, of those that start together the first of KINDS. A text without spans,
    empty or null stays as it is, and so do all other columns, whatever their names.
    """
    text = F.col("row")[text_col].cast("string")
    placed = spans(found, model).select(
        "row",
        F.when(F.size("all") > 0, _regions(F.col("all"))).alias("regions"),
    )
    cut = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{STRETCH}}}"), F.lit(0))
    cut = placed.withColumn("stretches", F.when(F.col("regions").isNotNull(), cut))

    def within(number: Column) -> Column:
        low = number.cast("long") * STRETCH
        regions = F.filter("regions", lambda r: (r["start"] < low + STRETCH) & (r["end"] > low))
        return F.struct(low.alias("low"), regions.alias("regions"))

    numbers = F.sequence(F.lit(0), F.size("stretches") - 1)
    cut = cut.withColumn(
        "within", F.when(F.size("stretches") > 0, F.transform(numbers, within))
    )
    whole = F.array_join(F.zip_with("stretches", "within", _replaced), "")
    result = F.when(F.col("regions").isNotNull(), whole).otherwise(text)
    names = found.schema["row"].dataType.names
    return cut.select(
        *[(result if name == text_col else F.col("row")[name]).alias(name) for name in names]
    )


def masked(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with every span in ``text_col`` replaced by its kind; see ``masked_rows``.

    Repeated rows stay repeated and an empty table gives an empty result.
    """
    return masked_rows(candidates_in_rows(docs, text_col), model, text_col)
