"""Secret scans: fixed patterns, and character Markov models compared by log-likelihood ratio.

One model describes random strings, the other ordinary identifiers; both are first-order chains over
characters, trained from labelled samples.  A long token whose log-likelihood ratio is high, in all
and for each pair of characters, is a span of kind ``random``.  Everything is column expressions: the
table of ratios is a literal.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.llm.shared import share_of

# Kinds of spans in their order, with the patterns of the first three.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = (
    r"(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]"
    r"|[aA][pP][iI]_?[kK][eE][yY])[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9+/_.=-]+"
)
ASSIGN_VALUE = r"^[A-Za-z_]+[\"']?\x20*[:=]\x20*[\"']?"
#: A maximal run is matched whole, so a lower bound in the pattern equals a later test of its length.
PATTERNS = {"assign": ASSIGN, "access": "AKIA[A-Z0-9]{16,}", "hex": "[0-9a-f]{24,}"}
LEAST_VALUE = 6
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
#: Tokens that the models judge: whole runs of the alphabet, of this length at least.
TOKEN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{%d,}"
LEAST_TOKEN = 20
#: Natural logarithm of the ratio from which a token counts as random, and its mean over the pairs:
#: the sum alone grows with the length, so a few odd pairs would make a long path random.
RATIO = 12.0
MEAN_RATIO = 0.5
#: Identifiers by their shape: 8-4-4-4-12 hex digits, as the models cannot tell them from random ones.
UUID = "^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$"
#: Documents that samples are taken from, about.
SAMPLE_DOCS = 4_000
#: Matches of a text whose positions are summed in one run.
RUN = 256
MASK = "[SECRET]"

_SIZE = len(ALPHABET) + 1
#: Weight of single characters beside the pairs seen.
_BACK_OFF = 4.0
#: Share of single characters in every chance, so that no pair weighs much for being unseen.
_BLEND = 0.02


def _bound(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def located(text: Column, pattern: str) -> Column:
    """All matches in order: array of (start, end, match), in code points.

    The pieces between matches and the matches alternate; positions are running sums of their
    lengths, within runs of RUN matches and then over the runs, so that texts with very many matches
    stay cheap.
    """
    none = F.expr("cast(array() as array<struct<start: int, end: int, match: string>>)")

    def placed(found: Column) -> Column:
        def steps(pieces: Column) -> Column:
            return F.transform(found, lambda m, i: F.struct(F.length(pieces[i]).alias("gap"), F.length(m).alias("size"), m.alias("match")))

        def run(part: Column, at: Column) -> Column:
            begin = F.struct(at.alias("at"), none.alias("out"))
            return F.aggregate(
                part,
                begin,
                lambda acc, s: F.struct(
                    (acc["at"] + s["gap"] + s["size"]).alias("at"),
                    F.concat(
                        acc["out"],
                        F.array(
                            F.struct(
                                (acc["at"] + s["gap"]).alias("start"),
                                (acc["at"] + s["gap"] + s["size"]).alias("end"),
                                s["match"].alias("match"),
                            )
                        ),
                    ).alias("out"),
                ),
                lambda acc: acc["out"],
            )

        def in_runs(all_steps: Column) -> Column:
            runs = F.transform(
                F.sequence(F.lit(0), ((F.size(all_steps) - 1) / RUN).cast("int")),
                lambda b: F.slice(all_steps, b * RUN + 1, F.lit(RUN)),
            )

            def summed(parts: Column) -> Column:
                lengths = F.transform(parts, lambda p: F.aggregate(p, F.lit(0), lambda acc, s: acc + s["gap"] + s["size"]))
                starts = F.aggregate(
                    lengths,
                    F.array(F.lit(0)),
                    lambda acc, n: F.concat(acc, F.array(F.element_at(acc, -1) + n)),
                )
                return _bound(starts, lambda at: F.flatten(F.transform(parts, lambda p, i: run(p, at[i]))))

            return _bound(runs, summed)

        pieces = F.split(text, pattern, -1)
        return F.when(F.size(found) == 0, none).otherwise(_bound(pieces, lambda p: _bound(steps(p), in_runs)))

    return _bound(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), placed)


def _topped(items: Column, reach) -> Column:
    """Each item in order with ``top``, the greatest ``reach(item)`` of those before it (0 for the first).

    Within runs of RUN items and then over the runs, so that very many items stay cheap.
    """

    def run(part: Column, top: Column) -> Column:
        step = lambda top, x: F.struct(top.alias("top"), x.alias("item"))
        steps = F.aggregate(part, F.array(top), lambda acc, x: F.concat(acc, F.array(F.greatest(F.element_at(acc, -1), reach(x)))))
        return _bound(steps, lambda tops: F.zip_with(F.slice(tops, 1, F.size(part)), part, step))

    def over(parts: Column) -> Column:
        highest = F.transform(parts, lambda p: F.array_max(F.transform(p, reach)))
        tops = F.aggregate(highest, F.array(F.lit(0)), lambda acc, x: F.concat(acc, F.array(F.greatest(F.element_at(acc, -1), x))))
        return _bound(tops, lambda at: F.flatten(F.transform(parts, lambda p, i: run(p, at[i]))))

    runs = F.transform(F.sequence(F.lit(0), ((F.size(items) - 1) / RUN).cast("int")), lambda b: F.slice(items, b * RUN + 1, F.lit(RUN)))
    return _bound(runs, over)


def _spans(kind: str, matches: Column) -> Column:
    order = KINDS.index(kind)
    return F.transform(matches, lambda m: F.struct(m["start"].alias("start"), F.lit(order).alias("kind"), m["end"].alias("end")))


def base_spans(text: Column, kind: str) -> Column:
    """Spans of a fixed pattern: array of (start, kind, end)."""
    found = located(text, PATTERNS[kind])
    if kind == "assign":
        found = F.filter(found, lambda m: F.length(F.regexp_replace(m["match"], ASSIGN_VALUE, "")) >= LEAST_VALUE)
    return _spans(kind, found)


def _places(token: Column) -> Column:
    """Numbers of the bigrams of a token; characters outside the alphabet share the number 0."""
    chars = F.split(token, "")
    return _bound(
        F.transform(chars, lambda c: F.instr(F.lit(ALPHABET), c)),
        lambda at: F.zip_with(F.slice(at, 1, F.greatest(F.size(at) - 1, F.lit(0))), F.slice(at, 2, F.size(at)), lambda a, b: a * _SIZE + b),
    )


def train(samples: DataFrame, token: str = "token", label: str = "is_random") -> list[float]:
    """Log-likelihood ratios of all bigrams, from tokens labelled random (true) or ordinary (false).

    Bigrams are counted by Spark; at most two rows per pair of characters reach the driver.  A
    character after another backs off to the character alone, whose count is smoothed by a half, so
    without samples every ratio is 0 and nothing is random.
    """
    pairs = samples.where(F.col(token).isNotNull()).select(F.col(label).alias("label"), F.explode(_places(F.col(token))).alias("pair"))
    counts = {(r["label"], r["pair"]): r["n"] for r in pairs.groupBy("label", "pair").agg(F.count("*").alias("n")).collect()}
    chance: dict[bool, list[list[float]]] = {}
    for x in (True, False):
        n = [[counts.get((x, a * _SIZE + b), 0) for b in range(_SIZE)] for a in range(_SIZE)]
        single = [sum(column) + 0.5 for column in zip(*n, strict=True)]
        total = sum(single)
        alone = [s / total for s in single]
        paired = [[(k + _BACK_OFF * a) / (sum(row) + _BACK_OFF) for k, a in zip(row, alone, strict=True)] for row in n]
        chance[x] = [[(1 - _BLEND) * p + _BLEND * a for p, a in zip(row, alone, strict=True)] for row in paired]
    return [math.log(r / o) for rs, os in zip(chance[True], chance[False], strict=True) for r, o in zip(rs, os, strict=True)]


def ratio(token: Column, table: list[float]) -> Column:
    """Log-likelihood ratio of a token, random against ordinary."""
    literal = F.split(F.lit(" ".join(f"{x:.6g}" for x in table)), " ").cast("array<double>")
    return F.aggregate(_places(token), F.lit(0.0), lambda acc, i: acc + F.get(literal, i))


def looks_random(token: Column, table: list[float], ratio_from: float = RATIO, mean_from: float = MEAN_RATIO) -> Column:
    """Whether a token is random: by its ratio, in all and for each pair, and no identifier by its shape."""
    enough = _bound(ratio(token, table), lambda x: (x >= ratio_from) & (x >= mean_from * (F.length(token) - 1)))
    return enough & ~token.rlike(UUID)


def _identifiers(text: Column) -> Column:
    """Identifiers of the usual forms, made of the words of a text: four neighbours each, the forms in turn."""
    words = F.regexp_extract_all(text, F.lit("[A-Za-z]{2,}"), F.lit(0))

    def forms(all_words: Column) -> Column:
        def form(i: Column) -> Column:
            four = F.slice(all_words, i * 4 + 1, F.lit(4))
            small, capital = F.transform(four, F.lower), F.transform(four, F.initcap)
            year = (F.lit(1990) + F.pmod(F.crc32(small[0].cast("binary")), F.lit(40))).cast("string")
            day = F.lpad(F.pmod(F.crc32(F.reverse(small[0]).cast("binary")), F.lit(31)).cast("string"), 2, "0")
            camel = F.array_join(capital, "")
            kinds = [
                F.concat(F.lower(F.substring(camel, 1, 1)), F.substring(camel, 2, 1000)),
                camel,
                F.array_join(small, "_"),
                F.array_join(small, "-"),
                F.concat(F.lit("/"), F.array_join(small, "/")),
                F.upper(F.array_join(small, "_")),
                F.concat_ws("/", F.concat(F.lit("/"), small[0]), year, day, F.concat_ws("-", F.array_join(F.slice(small, 2, 3), "-"), day)),
                F.concat(F.array_join(small, "_"), F.lit("="), day),
                F.concat_ws("-", year, day, F.array_join(capital, "-")),
                F.concat_ws("/", F.lit(""), small[0], F.array_join(F.slice(capital, 2, 2), ""), F.concat_ws("_", F.element_at(small, -1), day)),
            ]
            turn = F.pmod(i, F.lit(len(kinds)))
            made = kinds[-1]
            for n, kind in enumerate(kinds[:-1]):
                made = F.when(turn == n, kind).otherwise(made)
            return made

        fours = F.sequence(F.lit(1), (F.size(all_words) / 4).cast("int"))
        return F.when(F.size(all_words) >= 4, F.transform(fours, lambda i: form(i - 1))).otherwise(F.array().cast("array<string>"))

    return _bound(words, forms)


def labelled_samples(docs: DataFrame, text: str = "text", rows: int = SAMPLE_DOCS) -> DataFrame:
    """``token`` and ``is_random`` from a bounded sample of documents, chosen by a hash of the distinct texts.

    Ordinary: the long words that are left when what the patterns find is taken out, identifiers made of
    neighbouring words (camel and snake case, paths, dates, assignments) and rulers of one character.
    Random: the values that the patterns find, and digests of the texts in three alphabets, so that a
    corpus without secrets gives a model, too.
    """
    known = docs.where(F.col(text).isNotNull())
    # Copies of a text count once, so that a hot one cannot carry the sample beyond its bound.
    some = known.where(share_of(F.col(text), known.count(), rows)).select(F.col(text).alias("t")).distinct()
    any_base = "|".join(f"(?:{p})" for p in PATTERNS.values())
    rest = F.regexp_replace("t", any_base, " ")
    words = F.regexp_extract_all(rest, F.lit(TOKEN % 6), F.lit(0))
    digest = F.unhex(F.sha2("t", 256))
    made = F.array(F.sha2("t", 224), F.base64(digest), F.upper(F.conv(F.substring(F.sha2("t", 256), 1, 15), 16, 36)))
    hits = F.regexp_extract_all("t", F.lit(any_base), F.lit(0))
    values = F.transform(hits, lambda m: F.regexp_replace(m, ASSIGN_VALUE, ""))
    rulers = F.array(*[F.lit(c * 30) for c in "=-_/+"], *[F.lit(c * 8) for c in "aAxX0"])
    ordinary = F.concat(words, _identifiers(rest), rulers)
    tagged = some.select(F.explode(ordinary).alias("token"), F.lit(False).alias("is_random"))
    return tagged.unionByName(some.select(F.explode(F.concat(made, values)).alias("token"), F.lit(True).alias("is_random")))


def scan(
    docs: DataFrame,
    table: list[float],
    text: str = "text",
    ratio_from: float = RATIO,
    least_token: int = LEAST_TOKEN,
    mean_from: float = MEAN_RATIO,
) -> DataFrame:
    """``docs`` as struct ``row`` with ``spans``: array of (start, kind, end), sorted.

    ``kind`` is the place in KINDS; positions are code points, the end is exclusive.  The spans of a
    fixed kind don't overlap; spans of kind ``random`` are tokens that lie wholly inside none of the
    fixed kinds, but may overlap them.  A NULL text is empty and has no spans.  Rows are independent.
    """
    value = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), value.alias("text"))
    tokens = F.filter(located(F.col("text"), TOKEN % least_token), lambda m: looks_random(m["match"], table, ratio_from, mean_from))
    fixed = F.concat(*[base_spans(F.col("text"), k) for k in KINDS[:3]])
    random = KINDS.index("random")

    # A token lies wholly inside a fixed span if one that begins no later ends no earlier.
    def ends(s: Column) -> Column:
        return F.when(s["kind"] < random, s["end"]).otherwise(0)

    def outside(spans: Column) -> Column:
        kept = F.filter(_topped(spans, ends), lambda x: (x["item"]["kind"] < random) | (x["top"] < x["item"]["end"]))
        return F.when(F.size(spans) > 0, F.transform(kept, lambda x: x["item"])).otherwise(spans)

    return rows.select("row", _bound(F.array_sort(F.concat(fixed, _spans("random", tokens))), outside).alias("spans"))


def described(spans: Column, *kinds: str) -> Column:
    """kind:start:end of the spans of these kinds (all if none is named), comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    wanted = F.filter(spans, lambda s: s["kind"].isin([KINDS.index(k) for k in kinds])) if kinds else spans
    return F.array_join(
        F.transform(wanted, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def counted(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("long")


def masked(text: Column, spans: Column, mask: str = MASK) -> Column:
    """``text`` with each span, or run of overlapping spans, replaced by ``mask``.

    Pieces are cut out of a form of four bytes a character, where any place is reached at once, so the
    time grows with the text and the spans, not with their product.
    """
    # The mark of the byte order is spent by decoding; without it a text's own would be.
    order = F.unhex(F.lit("0000FEFF"))

    def pieces(wide: Column) -> Column:
        def cut(start: Column, end: Column) -> Column:
            return F.decode(F.concat(order, F.substring(wide, start * 4 + 1, F.greatest(end - start, F.lit(0)) * 4)), "UTF-32")

        def all_of(topped: Column) -> Column:
            between = F.transform(
                F.filter(topped, lambda x: x["item"]["start"] >= x["top"]),
                lambda x: F.concat(cut(x["top"], x["item"]["start"]), F.lit(mask)),
            )
            last = F.element_at(topped, -1)
            tail = cut(F.greatest(last["top"], last["item"]["end"]), F.length(text))
            return F.concat(F.array_join(between, ""), tail)

        return _bound(_topped(spans, lambda s: s["end"]), all_of)

    return F.when(F.size(spans) > 0, _bound(F.encode(text, "UTF-32"), pieces)).otherwise(text)


def mask_secrets(docs: DataFrame, text: str = "text", n_chars: str | None = "n_chars") -> DataFrame:
    """``docs`` with secrets masked in the text, and the count of characters brought up to date.

    Every row stays; rows without secrets stay unchanged (NULL texts too).
    """
    found = scan(docs, train(labelled_samples(docs, text)), text)
    clean = masked(F.col(f"row.`{text}`"), F.col("spans"))
    changed = {text: clean}
    if n_chars in docs.columns:
        changed[n_chars] = F.when(F.size("spans") > 0, F.length(clean).cast(docs.schema[n_chars].dataType)).otherwise(F.col(f"row.`{n_chars}`"))
    return found.select(*[changed.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
