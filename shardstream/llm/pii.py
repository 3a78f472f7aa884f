"""Personal data: fixed forms, and identifiers that stand where those forms stand.

Emails, addresses, cards and phone numbers are found by their form. They are the seeds of a bootstrap: the words around
them are patterns, a pattern is trusted as far as the instances seen in it are, and an instance as far as the patterns
it is seen in. After some rounds, what stands in trusted patterns is an identifier too, whatever its form.

All of it is made of DataFrame functions.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shardstream.llm.common import pin
from shardstream.operators.shards import fits_broadcast

# The forms of the kinds. Possessive, and tried only where a run begins or a match has ended, which matches the
# same: a run that fails from its start fails from any place in it. So no text takes more than one look at each run.
FORMS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
KINDS = [*FORMS, "id"]
#: What a form needs to be looked for at all.
HINTS = {"email": "@", "ip": ".", "phone": "+"}
CARD_DIGITS, PHONE_DIGITS = (14, 19), (10, 15)

#: Words with at least three digits: instances besides the seeds from which patterns are learned.
INSTANCE = (
    r"(?<![A-Za-z0-9])(?=(?:[A-Za-z_.:@+/-]{0,64}+[0-9]){3})[A-Za-z0-9][A-Za-z0-9_.:@+/-]{4,}[A-Za-z0-9](?![A-Za-z0-9])"
)
#: What contexts are made of: runs of letters and digits, and runs of other signs.
PIECE = r"[\p{L}\p{N}\p{M}]+|[^\s\p{L}\p{N}\p{M}]+"
BESIDE = 40
ROUNDS = 3
#: Elements of an array that are put together at a time.
BLOCK = 128
#: Beyond any place in a text.
FAR = 1 << 62
#: A piece that opens or ends stretches has a form's match beside it in at least this share of its places in the corpus.
LEAST_SHARE = 0.2
#: Words between white space that a stretch between two contexts may have.
MOST_WORDS = 12
#: A pattern is trusted from this score on, and if it was seen around so many different instances.
TRUSTED, LEAST_INSTANCES = 0.8, 5
#: Instances of no worth that every pattern is given, so that a few good ones prove little.
DOUBT = 1.0

SPAN = "struct<start: bigint, rank: int, end: bigint, kind: string, value: string, left: string, right: string>"


def spans_of(text: Column, form: str, kind: str) -> Column:
    """Leftmost non-overlapping matches with their places in characters and the characters beside them.

    What is between the matches is what splitting leaves, so places are sums of lengths.
    """
    matches, between = F.regexp_extract_all(text, F.lit(form), 0), F.split(text, form, -1)
    following = F.slice(between, F.lit(2), F.size(matches))
    parts = F.zip_with(
        F.zip_with(F.slice(between, F.lit(1), F.size(matches)), matches, lambda b, m: F.struct(b.alias("before"), m.alias("value"))),
        following,
        lambda p, a: F.struct(p["before"].alias("before"), p["value"].alias("value"), a.alias("after")),
    )
    rank = KINDS.index(kind)

    def lengths(part: Column) -> Column:
        return (F.length(part["before"]) + F.length(part["value"])).cast("bigint")

    def span(part: Column, at: Column) -> Column:
        start = at + F.length(part["before"])
        return F.struct(
            start.alias("start"),
            F.lit(rank).alias("rank"),
            (start + F.length(part["value"])).alias("end"),
            F.lit(kind).alias("kind"),
            part["value"].alias("value"),
            F.right(part["before"], F.lit(BESIDE)).alias("left"),
            F.left(part["after"], F.lit(BESIDE)).alias("right"),
        )

    found = once(parts, lambda ps: F.zip_with(ps, before_each(F.transform(ps, lengths), lambda a, n: a + n, 0), span))
    none = F.array().cast(f"array<{SPAN}>")
    return F.when(F.size(matches) > 0, found).otherwise(none)


def before_each(numbers: Column, op: Callable[[Column, Column], Column], none: int) -> Column:
    """For each place of an array what ``op`` makes of the numbers before it, ``none`` where there are none.

    That is made in blocks, as appending to an array copies it: what is copied grows with the array's length times BLOCK.
    """
    first = F.lit(none).cast("bigint")

    def one_by_one(some: Column, start: Column) -> Column:
        def add(state: Column, n: Column) -> Column:
            return F.struct(op(state["at"], n).alias("at"), F.concat(state["out"], F.array(state["at"])).alias("out"))

        empty = F.array().cast("array<bigint>")
        return F.aggregate(some, F.struct(start.alias("at"), empty.alias("out")), add, lambda s: s["out"])

    def of_blocks(blocks: Column) -> Column:
        totals = F.transform(blocks, lambda b: F.aggregate(b, first, op))
        return F.flatten(F.zip_with(blocks, one_by_one(totals, first), one_by_one))

    def in_blocks(all_: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.greatest(F.size(all_) - 1, F.lit(0)), F.lit(BLOCK))
        return F.transform(numbers, lambda k: F.slice(all_, k + 1, F.lit(BLOCK)))

    return once(numbers, lambda all_: once(in_blocks(all_), of_blocks))


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often it stands in what is made of it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def apart_from(words: Column, base: Column) -> Column:
    """The words that meet no span of ``base``, which is in order of start; one look at each."""

    def of(all_: Column) -> Column:
        is_base = lambda s: s["rank"] < KINDS.index("id")
        ends = F.transform(all_, lambda s: F.when(is_base(s), s["end"]).otherwise(0).cast("bigint"))
        starts = F.transform(F.reverse(all_), lambda s: F.when(is_base(s), s["start"]).otherwise(FAR).cast("bigint"))
        before = before_each(ends, lambda a, x: F.greatest(a, x), 0)
        after = F.reverse(before_each(starts, lambda a, x: F.least(a, x), FAR))
        beside = F.zip_with(before, after, lambda b, a: F.struct(b.alias("before"), a.alias("after")))
        each = F.zip_with(all_, beside, lambda s, n: F.struct(s.alias("s"), n.alias("n")))
        kept = F.filter(
            each, lambda e: ~is_base(e["s"]) & (e["n"]["before"] <= e["s"]["start"]) & (e["n"]["after"] >= e["s"]["end"])
        )
        return F.transform(kept, lambda e: e["s"])

    simple = (F.size(words) == 0) | (F.size(base) == 0)
    return F.when(simple, words).otherwise(once(F.array_sort(F.concat(base, words)), of))


def longest(spans: Column) -> Column:
    """The spans that lie in no longer one."""

    def of(ordered: Column) -> Column:
        reach = before_each(F.transform(ordered, lambda o: o["s"]["end"].cast("bigint")), lambda a, x: F.greatest(a, x), -1)
        each = F.zip_with(ordered, reach, lambda o, r: F.struct(o["s"].alias("s"), r.alias("r")))
        return F.transform(F.filter(each, lambda e: e["r"] < e["s"]["end"]), lambda e: e["s"])

    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"], (-s["end"]).alias("back"), s.alias("s"))))
    return once(ordered, of)


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """True where the digits of a string pass Luhn's check."""

    def add(total: Column, place: Column) -> Column:
        digit = F.substring(number, -place, F.lit(1)).cast("int") * F.when(place % 2 == 0, 2).otherwise(1)
        return total + F.when(digit > 9, digit - 9).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), F.length(number)), F.lit(0), add) % 10 == 0


def is_valid(span: Column, kind: str) -> Column:
    number = digits(span["value"])
    if kind == "ip":
        shorts = F.transform(F.split(span["value"], r"\."), lambda p: F.regexp_replace(p, "^0+", ""))
        return F.forall(shorts, lambda p: (F.length(p) < 3) | ((F.length(p) == 3) & (p <= "255")))
    if kind == "card":
        return F.when(F.length(number).between(*CARD_DIGITS), luhn(number)).otherwise(False)
    if kind == "phone":
        return F.length(number).between(*PHONE_DIGITS)
    return F.lit(True)


def base_spans(text: Column, kind: str) -> Column:
    found = F.filter(spans_of(text, FORMS[kind], kind), lambda s: is_valid(s, kind))
    hint = F.contains(text, F.lit(HINTS[kind])) if kind in HINTS else text.rlike("[0-9](?:[ -]?[0-9]){13}")
    return F.when(hint, found).otherwise(F.array().cast(f"array<{SPAN}>"))


def folded(text: Column) -> Column:
    """Lower case, and digits as one sign; it has as many pieces as the text."""
    return F.regexp_replace(F.lower(text), "[0-9]+", "9")


def contexts(left: Column, right: Column) -> Column:
    """Patterns around a span, (kind, left, right) in lines: two pieces before, a word on each side, two pieces after.

    A word is a piece of letters and digits, or signs with the piece beyond them.
    """
    before, after = (F.regexp_extract_all(folded(side), F.lit(PIECE), 0) for side in (left, right))
    last_two, first_two = F.slice(before, F.greatest(F.size(before) - 1, F.lit(1)), F.lit(2)), F.slice(after, 1, 2)
    last, first = F.try_element_at(before, F.lit(-1)), F.try_element_at(after, F.lit(1))
    is_word = lambda piece: piece.rlike(r"^[\p{L}\p{N}\p{M}]")
    pair = lambda two: F.when(F.size(two) == 2, F.array_join(two, " "))
    beside = [F.when(is_word(one), one).otherwise(pair(two)) for one, two in ((last, last_two), (first, first_two))]
    return F.array_compact(
        F.array(
            F.concat(F.lit("before\n"), pair(last_two), F.lit("\n")),
            F.concat(F.lit("around\n"), beside[0], F.lit("\n"), beside[1]),
            F.concat(F.lit("after\n\n"), pair(first_two)),
        )
    )


def shape(value: Column) -> Column:
    """A pattern of an instance itself: how many digits it has, by powers of two."""
    many = F.length(digits(value))
    return F.when(many > 0, F.concat(F.lit("shape\n"), F.floor(F.log2(many)).cast("string"), F.lit("\n")))


def trusted_patterns(seen: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """Patterns of high score, and whether at least half of their instances are seeds (``known``), from ``seen`` (pattern,
    instance, seed), one row for each pattern an instance is in.

    A pattern's score is the mean score of its different instances, with ``DOUBT`` instances of score 0 besides; an
    instance's score is 1 for a seed, else the chance that not all of its patterns are wrong. Sums are made before rows
    are shuffled, also for a pattern that a third of all instances have.
    """
    edges = pin(seen.groupBy("pattern", "instance").agg(F.max("seed").alias("seed")), "patterns")
    scores = edges.groupBy("instance").agg(F.max(F.col("seed").cast("double")).alias("score"))
    for _ in range(rounds):
        scores = pin(scores, "instances")
        known = edges.join(scores, "instance")
        patterns = known.groupBy("pattern").agg(
            (F.sum("score") / (F.count("*") + DOUBT)).alias("trust"), F.count("*").alias("instances"), F.count_if("seed").alias("seeds")
        )
        patterns = pin(patterns, "patterns")
        wrong = F.exp(F.sum(F.log1p(-F.col("trust"))))
        scores = edges.join(patterns, "pattern").groupBy("instance").agg(
            F.when(F.max("seed"), 1.0).otherwise(1 - wrong).alias("score")
        )
    trusted = patterns.filter((F.col("trust") >= TRUSTED) & (F.col("instances") >= LEAST_INSTANCES))
    return trusted.select("pattern", (2 * F.col("seeds") >= F.col("instances")).alias("known"))


def marks_of(patterns: DataFrame) -> DataFrame:
    """(piece, beyond, opens, between): the pieces of patterns that a stretch begins after or ends before, with the piece
    beyond them, if it matters. A stretch lies between two marks of one ``between``: those of one pattern on both sides,
    or of any pattern before and any after."""
    return _marks(patterns.withColumn("n", F.lit(1))).select("piece", "beyond", "opens", "between").distinct()


def _marks(patterns: DataFrame) -> DataFrame:
    """The marks of patterns (pattern, n), those on both sides of a pattern in two rows."""
    parts = F.split("pattern", "\n")
    patterns = patterns.filter(parts[0] != "shape")
    sides = patterns.select("pattern", "n", parts[0].alias("kind"), F.split(parts[1], " ").alias("l"), F.split(parts[2], " ").alias("r"))
    between = F.when(F.col("kind") == "around", F.col("pattern")).otherwise("sides")
    two = lambda side: F.size(side) == 2
    lefts = sides.filter("kind <> 'after'").select(
        F.element_at("l", -1).alias("piece"), F.when(two("l"), F.col("l")[0]).alias("beyond"), F.lit(True).alias("opens"), between.alias("between"), "n", "kind"
    )
    rights = sides.filter("kind <> 'before'").select(
        F.col("r")[0].alias("piece"), F.when(two("r"), F.get("r", F.lit(1))).alias("beyond"), F.lit(False).alias("opens"), between.alias("between"), "n", "kind"
    )
    return lefts.unionByName(rights)


def base_and_words(text: Column) -> tuple[Column, Column]:
    """Spans of the forms, and the words with three digits, which may meet them."""
    base = F.array_sort(F.concat(*(base_spans(text, kind) for kind in FORMS)))
    return base, F.when(text.rlike("[0-9]"), spans_of(text, INSTANCE, "id")).otherwise(F.array().cast(f"array<{SPAN}>"))


def meet(one: Column, other: Column) -> Column:
    return (one["start"] < other["end"]) & (other["start"] < one["end"])


def same_text(key: list[str], other: str) -> Column:
    same = F.col(key[0]).eqNullSafe(F.col(f"{other}_{key[0]}"))
    for k in key[1:]:
        same = same & (F.col(k) == F.col(f"{other}_{k}"))
    return same


def marked(rows: DataFrame, marks: DataFrame, key: list[str]) -> DataFrame:
    """(key, n, opens, between, ...): every piece of every whole text that is a mark, with its number in the text."""
    pieces = F.regexp_extract_all(folded(F.col("text")), F.lit(PIECE), 0)
    texts = rows.select(*key, F.concat(F.array(F.lit("")), pieces, F.array(F.lit(""))).alias("p"))
    beside = F.arrays_zip(F.col("p").alias("prev"), F.slice("p", F.lit(2), F.size("p")).alias("piece"), F.slice("p", F.lit(3), F.size("p")).alias("next"))
    each = texts.select(*key, F.posexplode(beside).alias("n", "at")).select(*key, "n", "at.*").filter("piece <> ''")
    beyond = F.when(F.col("opens"), F.col("prev")).otherwise(F.col("next"))
    return each.join(marks, "piece").filter(F.col("beyond").isNull() | (F.col("beyond") == beyond))


def telling_marks(rows: DataFrame, marks: DataFrame, placed: DataFrame) -> DataFrame:
    """The marks that stand beside a form's match in at least ``LEAST_SHARE`` of their places in all texts.

    A context of common words is seen around many things that are no identifiers, of which the graph knows nothing yet. A
    word is judged by all its places, whatever stands beyond it, signs by those with the same piece beyond them: pairs of
    words are far more than words, pairs with signs are not. Places are counted before anything is shuffled.
    """
    side, is_sign = ["piece", "beyond", "opens"], lambda piece: ~piece.rlike(r"^[\p{L}\p{N}\p{M}]")
    pieces = F.regexp_extract_all(folded(F.col("text")), F.lit(PIECE), 0)
    p = rows.select(F.concat(F.array(F.lit("")), pieces).alias("p"))
    two = F.arrays_zip(F.col("p").alias("first"), F.slice("p", F.lit(2), F.size("p")).alias("second"))
    pairs = p.select(F.explode(two).alias("at")).select("at.*").filter("second is not null")
    first = F.when(is_sign(F.col("first")) | is_sign(F.col("second")), F.col("first"))
    pairs = pin(pairs.groupBy(first.alias("first"), "second").agg(F.count("*").alias("places")), "pairs")
    none = F.lit(None).cast("string")
    singles = pairs.groupBy(F.col("second").alias("piece")).agg(F.sum("places").alias("places"))
    before = pairs.filter(is_sign(F.col("second"))).selectExpr("second as piece", "first as beyond", "true as opens", "places")
    after = pairs.filter(is_sign(F.col("first"))).selectExpr("first as piece", "second as beyond", "false as opens", "places")
    for opens in (True, False):
        before = before.unionByName(singles.withColumns({"beyond": none, "opens": F.lit(opens)}))
    places = before.unionByName(after)

    def judged(table: DataFrame) -> DataFrame:
        return table.withColumn("judged", F.when(is_sign(F.col("piece")), F.col("beyond")))

    def same(a: str, b: str) -> Column:
        x, y = F.col(f"{a}.judged"), F.col(f"{b}.beyond")
        return (F.col(f"{a}.piece") == F.col(f"{b}.piece")) & x.eqNullSafe(y) & (F.col(f"{a}.opens") == F.col(f"{b}.opens"))

    # An instance has patterns of several kinds on one side: it counts as often as it has of one of them.
    forms = placed.filter("span.kind <> 'id'").groupBy("pattern").agg(F.count("*").alias("n"))
    beside = judged(_marks(forms)).groupBy("piece", F.col("judged").alias("beyond"), "opens", "kind").agg(F.sum("n").alias("n"))
    beside = beside.groupBy(*side).agg(F.max("n").alias("beside"))
    telling = judged(marks).alias("m").join(places.alias("p"), same("m", "p")).select("m.*", "places")
    telling = telling.alias("m").join(beside.alias("b"), same("m", "b")).filter(F.col("beside") >= LEAST_SHARE * F.col("places"))
    kept = pin(telling.select(*(F.col(f"m.{c}").alias(c) for c in (*side, "between"))).distinct(), "telling")
    both = kept.groupBy("between").agg(F.count_if("opens").alias("opening"), F.count_if(~F.col("opens")).alias("closing"))
    return kept.join(both.filter("opening > 0 and closing > 0").select("between"), "between", "left_semi")


def stretches(rows: DataFrame, marks: DataFrame, key: list[str]) -> DataFrame:
    """(id, text_hash, length, span): from each mark that opens to the next mark, if that one ends, in every whole text.

    Left out is what meets a form, is one of the words with three digits, or has no letter or digit. Texts become rows of
    pieces, of which only those that are marks are shuffled.
    """
    met = marked(rows, marks, key)
    place = F.col("n") + F.col("opens").cast("int")
    met = met.select(*key, "between", "opens", place.alias("place")).distinct()
    later = Window.partitionBy(*key, "between").orderBy(F.desc("place"), F.desc("opens"))
    pairs = met.withColumn("until", F.lag("place").over(later)).withColumn("then_opens", F.lag("opens").over(later))
    pairs = pairs.filter("opens and not then_opens")
    places = F.array_sort(F.collect_set(F.struct("place", "until"))).alias("places")
    pairs = pairs.groupBy(*(F.col(k).alias(f"met_{k}") for k in key)).agg(places)
    base, words = base_and_words(F.col("text"))
    parts = {"text": F.col("text"), "places": F.col("places"), "base": base, "words": words}
    parts |= {"p": F.regexp_extract_all("text", F.lit(PIECE), 0), "gaps": F.split("text", PIECE, -1)}
    # an array of one, so that each part is made once for all stretches
    whole = F.array(F.struct(*(c.alias(name) for name, c in parts.items())))
    spans = F.flatten(F.transform(whole, stretches_of))
    return rows.join(pairs, same_text(key, "met")).select(*key, F.explode(spans).alias("span")).distinct()


def stretches_of(doc: Column) -> Column:
    """Spans of a text's stretches, from struct (text, places in order, base, words, pieces ``p`` and ``gaps`` around them)."""

    def long(array: str, start: Column, until: Column) -> Column:
        return F.length(F.array_join(F.slice(doc[array], start + 1, until - start), "")).cast("bigint")

    def add(state: Column, at: Column) -> Column:
        start = state["start"] + long("p", state["n"], at["place"]) + long("gaps", state["n"] + 1, at["place"] + 1)
        end = long("p", at["place"], at["until"]) + long("gaps", at["place"] + 1, at["until"])
        one = F.struct(start.alias("start"), end.alias("length"))
        return F.struct(at["place"].alias("n"), start.alias("start"), F.concat(state["found"], F.array(one)).alias("found"))

    none = F.array().cast("array<struct<start: bigint, length: bigint>>")
    first = F.struct(F.lit(0).alias("n"), F.length(doc["gaps"][0]).cast("bigint").alias("start"), none.alias("found"))
    placed = F.aggregate(doc["places"], first, add, lambda s: s["found"])

    def span(at: Column) -> Column:
        start, end = at["start"].cast("int"), (at["start"] + at["length"]).cast("int")
        left = F.greatest(start - BESIDE, F.lit(0))
        return F.struct(
            at["start"].alias("start"),
            F.lit(KINDS.index("id")).alias("rank"),
            (at["start"] + at["length"]).alias("end"),
            F.lit("id").alias("kind"),
            F.substring(doc["text"], start + 1, end - start).alias("value"),
            F.substring(doc["text"], left + 1, start - left).alias("left"),
            F.substring(doc["text"], end + 1, F.lit(BESIDE)).alias("right"),
        )

    def counts(here: Column) -> Column:
        fits = here["value"].rlike(r"[\p{L}\p{N}]") & (F.size(F.split(here["value"], r"\s+")) <= MOST_WORDS)
        same = F.exists(doc["words"], lambda w: (w["start"] == here["start"]) & (w["end"] == here["end"]))
        return fits & ~same & ~F.exists(doc["base"], lambda b: meet(here, b))

    return F.filter(F.transform(placed, span), counts)


def find_spans(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS, carried: Sequence[str] = ()
) -> DataFrame:
    """Find personal data in every whole text: the id, ``text_hash``, ``length``, ``base`` and ``spans``, both arrays in order of
    start, then kind, of (start, rank, end, kind, value, left, right); ``spans`` has ``base`` and what patterns found.
    ``carried`` columns of ``docs`` are passed on; they must not have the names of these.

    Patterns are the pieces beside an instance, and the number of its digits. Instances are the matches of the forms, words
    with three digits or more, and, where a pattern's pieces stand beside forms in a good part of their places, what
    stands between such pieces.

    A null or empty text has no spans. Null ids are kept; rows that repeat an id and a text get the same spans, and rows
    that repeat an id with other texts their own. An empty table gives an empty table; other columns are not read.
    Texts are looked through once for the forms, again to count the places of trusted patterns, and again for what stands
    between them; only texts with such stretches may be shuffled.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    key = ["id", "text_hash", "length"]
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"), *(F.col(c).alias(f"carried_{c}") for c in carried))
    kept = [c for c in rows.columns if c.startswith("carried_")]
    rows = rows.select("id", F.xxhash64("text").alias("text_hash"), F.length("text").alias("length"), "text", *kept)
    base, words = base_and_words(F.col("text"))
    found = rows.select(*key, *kept, base.alias("base"), words.alias("words"))
    found = pin(found.withColumn("words", apart_from(F.col("words"), F.col("base"))), "spans")

    def place(spans: DataFrame) -> DataFrame:
        patterns = F.concat(contexts(F.col("span.left"), F.col("span.right")), F.array_compact(F.array(shape(F.col("span.value")))))
        return spans.select(*key, "span", F.explode(patterns).alias("pattern"))

    def seen(placed: DataFrame) -> DataFrame:
        instance = F.concat_ws(":", "span.kind", "span.value").alias("instance")
        return placed.select("pattern", instance, (F.col("span.kind") != "id").alias("seed"))

    all_spans = found.filter((F.size("base") > 0) | (F.size("words") > 0)).select(*key, F.explode(F.concat("base", "words")).alias("span"))
    placed = place(all_spans)
    trusted = pin(trusted_patterns(seen(placed), rounds), "trusted")
    marks = pin(marks_of(trusted.filter("known")), "marks")
    if not marks.isEmpty():
        marks = pin(telling_marks(rows, marks, placed), "marks")
    between = None
    if not marks.isEmpty():
        between = place(pin(stretches(rows, marks, key), "stretches"))
        trusted = pin(trusted_patterns(seen(placed).unionByName(seen(between)), rounds), "trusted")
    new = placed.filter("span.kind = 'id'").join(trusted, "pattern", "left_semi").select(*key, "span")
    if between is not None:
        sides = F.collect_set(F.split("pattern", "\n")[0])
        both_sides = between.join(trusted.filter("known"), "pattern", "left_semi").groupBy(*key, "span").agg(sides.alias("sides"))
        both_sides = both_sides.filter(F.array_contains("sides", "around") | F.expr("array_contains(sides, 'before') and array_contains(sides, 'after')"))
        new = new.unionByName(both_sides.select(*key, "span"))
    new = new.groupBy(*(F.col(k).alias(f"new_{k}") for k in key)).agg(F.collect_set("span").alias("new"))
    new = pin(new.withColumn("new", longest(F.col("new"))), "new")
    none = F.array().cast(f"array<{SPAN}>")
    new = F.broadcast(new) if fits_broadcast(new) else new
    both = found.drop("words").join(new, same_text(key, "new"), "left")
    spans = F.array_sort(F.concat("base", F.coalesce("new", none))).alias("spans")
    passed = [F.col(f"carried_{c}").alias(c) for c in carried]
    return both.select(F.col("id").alias(id_col), "text_hash", "length", "base", spans, *passed)


def written(spans: str) -> Column:
    """Spans as kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redacted(text: Column, spans: Column) -> Column:
    """The text with the kind in angle brackets in place of each span; spans that overlap are replaced by the first kind.

    Pieces are put together in blocks, as in ``before_each``.
    """

    def add(state: Column, span: Column) -> Column:
        apart = span["start"] >= state["at"]
        kept = F.array(
            F.concat(
                F.substring(text, (state["at"] + 1).cast("int"), (span["start"] - state["at"]).cast("int")),
                F.lit("<"), span["kind"], F.lit(">"),
            )
        )
        return F.struct(
            F.greatest(state["at"], span["end"]).alias("at"),
            F.when(apart, F.concat(state["out"], kept)).otherwise(state["out"]).alias("out"),
            state["done"].alias("done"),
        )

    def block(state: Column, k: Column) -> Column:
        empty = F.array().cast("array<string>")
        start = F.struct(state["at"].alias("at"), empty.alias("out"), state["done"].alias("done"))
        made = F.aggregate(F.slice(spans, k + 1, F.lit(BLOCK)), start, add)
        joined = lambda m: F.concat(m["done"], F.array(F.array_join(m["out"], "")))
        return once(made, lambda m: F.struct(m["at"].alias("at"), joined(m).alias("done")))

    numbers = F.sequence(F.lit(0), F.greatest(F.size(spans) - 1, F.lit(0)), F.lit(BLOCK))
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<string>").alias("done"))
    rest = lambda s: F.concat(F.array_join(s["done"], ""), F.substring(text, (s["at"] + 1).cast("int"), F.length(text)))
    return F.aggregate(numbers, start, block, rest)


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """The documents with personal data replaced by its kind, and ``length_col``, if there is one, set to the new length.

    Documents without spans are as before, null texts included; an empty table gives an empty table. Rows and other columns
    stay as they are, rows that repeat too. Texts go along with their spans and are not joined.
    """
    at = {c: f"column{k}" for k, c in enumerate(docs.columns)}  # names that no column beside them has
    rows = docs.withColumnsRenamed(at)
    found = find_spans(rows, at[id_col], at[text_col], carried=[c for c in at.values() if c != at[id_col]])
    text, hit = F.col(at[text_col]), F.col("hit")
    both = found.select(*at.values(), (F.size("spans") > 0).alias("hit"), "spans")
    both = both.withColumn("redacted", F.when(hit, redacted(text, F.col("spans"))))
    made = {text_col: F.when(hit, F.col("redacted")).otherwise(text)}
    if length_col in at:
        length = F.length("redacted").cast(docs.schema[length_col].dataType)
        made[length_col] = F.when(hit, length).otherwise(F.col(at[length_col]))
    return both.select(*(made.get(c, F.col(at[c])).alias(c) for c in docs.columns))
