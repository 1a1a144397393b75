"""Personal data: base patterns, and identifiers found by bootstrapped contexts.

All of it is DataFrame functions. Base matches are found with linear-time forms
of the patterns; their places come from the lengths of what lies before them.

Bootstrapping: every word with a digit or an @ is an instance, and groups of
digits with a space between them are one. Instances inside base matches are
seeds, and so are quoted lower-case hexadecimal strings, the seeds of secrets.
Each instance has several lexical patterns: one to three words before it in its
line, one or two after it, a word on either side, and the word before with the
shape of the instance. Where only one word stands before, the line's start or
the instance before makes up the second. Spark scores the pattern-instance graph
in rounds: a pattern's confidence for a kind is the share of its occurrences
that known instances of the kind make, with a least number of different known
instances, more of them for patterns of one word; an instance is known with the
confidence of its best pattern. What a sure pattern surrounds is added to the
spans, with the pattern's kind, if it looks like an identifier.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import forget, written

KINDS = ("email", "ip", "card", "phone")
#: All kinds; the last has no base pattern, only seeds.
NAMES = (*KINDS, "secret")
SECRET = len(KINDS)
#: Base patterns. A match may start where a run of its first characters starts or
#: where the last match ended (\G), which gives the leftmost matches without
#: trying every place of a long run.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A text without this has no match of the kind.
NEEDS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
#: A group of digits, no IP address, that ends where a word does, but for closing marks.
GROUP = r"(?![0-9]++(?:\.[0-9]++){3})[0-9]++(?:[./-][0-9]++)*+(?=[.,;:!?)\]}\"']*+(?:[\x20\x09-\x0D]|\z))"
#: Groups of digits with a space between them, or else a word with a digit or an @.
WORD = rf"(?<![^\x20\x09-\x0D])(?:[^\x20\x09-\x0D0-9@\p{{L}}]*+{GROUP}(?:\x20{GROUP})++|[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+)"
#: What stands in a pattern for a missing second word: the line's start or the instance before.
LINE_START, INSTANCE = "^", "#"
#: A seed of a secret: a quoted string of 32 to 64 lower-case hexadecimal digits.
SECRET_SEED = r"\A[^\p{L}0-9]*[\"'][0-9a-f]{32,64}[\"']"
#: Different seeds that a pattern needs, and how many times as many one with a single word does.
LEAST_SEEDS, SINGLE = 3, 3
LEAST_CONFIDENCE = 0.8
ROUNDS = 3
#: Digits, or an @ with letters around it, that an added identifier must have.
LEAST_DIGITS = 5
BLOCK = 64
#: Sure patterns up to which they are a map in the plan when texts are redacted; more are joined.
INLINE = 500
#: Sure patterns up to which their table is broadcast.
BROADCAST = 100_000


def _starts(lengths: Column, before: Column) -> Column:
    """Start of each match: all earlier pieces and matches, and its own piece.

    ``lengths``: piece plus match lengths; ``before``: piece lengths. Sums are
    taken by blocks, so that thousands of matches in a text cost little.
    """
    add = lambda a, x: a + x
    zero = F.lit(0).cast("long")
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / BLOCK).cast("int")), lambda b: F.aggregate(F.slice(lengths, b * BLOCK + 1, F.lit(BLOCK)), zero, add))
    ahead = F.transform(blocks, lambda _, b: F.aggregate(F.slice(blocks, F.lit(1), b), zero, add))

    def start(x: Column, i: Column) -> Column:
        block = F.floor(i / BLOCK).cast("int")
        return F.get(ahead, block) + F.aggregate(F.slice(lengths, block * BLOCK + 1, i - block * BLOCK), zero, add) + x

    return F.transform(before, start)


def _places(df: DataFrame, name: str, pattern: str, needs: Column, text: str = "text") -> DataFrame:
    """Column ``name``: array of (start, end, value, before, after) of the pattern's matches."""
    kind = "array<struct<start:bigint,end:bigint,value:string,before:string,after:string>>"
    df = df.withColumn("__m", F.when(needs, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))))
    df = df.withColumn("__p", F.when(F.size("__m") > 0, F.split(text, pattern, -1)))
    df = df.withColumn("__b", F.when(F.col("__p").isNotNull(), F.slice(F.transform("__p", lambda p: F.length(p).cast("long")), F.lit(1), F.size("__m"))))
    df = df.withColumn("__l", F.zip_with("__b", "__m", lambda b, m: b + F.length(m)))
    df = df.withColumn("__s", F.when(F.col("__b").isNotNull(), _starts(F.col("__l"), F.col("__b"))))
    found = F.transform("__m", lambda m, i: F.struct(F.get("__s", i).alias("start"), (F.get("__s", i) + F.length(m)).alias("end"), m.alias("value"), F.get("__p", i).alias("before"), F.get("__p", i + 1).alias("after")))
    return df.withColumn(name, F.coalesce(F.when(F.col("__p").isNotNull(), found), F.array().cast(kind))).drop("__m", "__p", "__b", "__l", "__s")


def _luhn(digits: Column) -> Column:
    """Whether a string of digits passes Luhn's check."""

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
        twice = d * 2 - F.when(d > 4, 9).otherwise(0)
        return total + F.when(i % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), add) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        part = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
        return value.rlike(rf"\A{part}(?:\.{part}){{3}}\z")
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "card":
        return F.when(F.length(digits).between(13, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def base_spans(documents: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, hash of the text, ``keep`` columns, spans (kind number, start, end, value) and words that may be instances, as of ``_instance``."""
    df = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), *[F.struct(*[F.col(f"`{k}`") for k in keep]).alias("__kept")] if keep else [])
    digit = F.col("text").rlike("[0-9]")
    df = df.withColumn("__digit", digit)
    for kind in KINDS:
        needs = F.contains("text", F.lit(NEEDS[kind])) if NEEDS[kind] else F.lit(True)
        df = _places(df, f"__{kind}", BASE[kind], needs & (F.lit(True) if kind == "email" else F.col("__digit")))
    df = _places(df, "words", WORD, F.col("__digit") | F.contains("text", F.lit("@")))

    def valid_spans(number: int, kind: str) -> Column:
        good = F.filter(f"__{kind}", lambda x: _valid(kind, x["value"]))
        return F.transform(good, lambda x: F.struct(F.lit(number).alias("kind"), x["start"].alias("start"), x["end"].alias("end"), x["value"].alias("value")))

    numbered = [valid_spans(n, k) for n, k in enumerate(KINDS)]
    spans = F.concat(*numbered)
    return df.select("doc_id", F.xxhash64("text").alias("text_hash"), *(["__kept"] if keep else []), spans.alias("spans"), F.transform(F.transform("words", _context), _instance).alias("words"))


def _shape(value: Column) -> Column:
    """Runs of digits as 9, of letters as a, and of both by turns as x."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(value, "[0-9]+", "9"), r"\p{L}+", "a"), "(?:9a)+9?|(?:a9)+a?", "x")


def _context(w: Column) -> Column:
    """Words around an instance, its identifier, its start, and what there is before its first word."""
    lexical = lambda piece: F.filter(F.split(F.lower(piece), r"[^\p{L}]+", -1), lambda x: x != "")
    # the words of the pieces between this instance and the next ones, in its line
    left = lexical(F.try_element_at(F.split(w["before"], "\n", -1), F.lit(-1)))
    right = lexical(F.get(F.split(w["after"], "\n", -1), F.lit(0)))
    opens = (w["start"] == F.length(w["before"])) | F.contains(w["before"], F.lit("\n"))
    core = F.regexp_extract(w["value"], r"[\p{L}0-9+].*(?<=[\p{L}0-9])", 0)
    start = w["start"] + F.length(F.regexp_extract(w["value"], r"\A[^\p{L}0-9+]*+", 0))
    return F.struct(left.alias("left"), right.alias("right"), F.when(opens, F.lit(LINE_START)).otherwise(F.lit(INSTANCE)).alias("edge"), core.alias("core"), start.alias("start"), w["value"].rlike(SECRET_SEED).alias("secret"))


def _instance(c: Column) -> Column:
    """Patterns (text, number of words), value, start, end of an identifier in its context, and whether it is the seed of a secret."""
    left, right, core = c["left"], c["right"], c["core"]
    near, next_, blank = F.try_element_at(left, F.lit(-1)), F.get(right, F.lit(0)), F.lit("_")
    some, follows = F.size(left) > 0, F.size(right) > 0
    form = lambda when, words, *parts: F.when(when, F.struct(F.concat_ws(" ", *parts).alias("pattern"), F.lit(words).alias("words")))
    forms = F.array(
        form(some, 2, F.when(F.size(left) >= 2, F.concat_ws(" ", F.slice(left, -2, 2))).otherwise(F.concat_ws(" ", c["edge"], near))),
        form(F.size(left) >= 3, 3, F.concat_ws(" ", F.slice(left, -3, 3)), blank),
        form(some, 1, near, blank),
        form(some, 1, near, _shape(core)),
        form(follows, 1, blank, next_),
        form(F.size(right) >= 2, 2, blank, F.concat_ws(" ", F.slice(right, 1, 2))),
        form(some & follows, 2, near, blank, next_),
    )
    return F.struct(F.filter(forms, lambda x: x.isNotNull()).alias("forms"), F.lower(core).alias("value"), c["start"].alias("start"), (c["start"] + F.length(core)).alias("end"), c["secret"].alias("secret"))


def _instances(base: DataFrame) -> DataFrame:
    """One row per word with a digit or @ and pattern of it: value, place, kind of its seed."""
    rows = base.where(F.size("words") > 0).select("doc_id", "text_hash", "spans", F.inline("words")).where("value != ''")
    rows = rows.withColumn("__in", _within(F.col("spans"), F.col("start"), F.col("end")))
    first = F.get("__in", F.lit(0))
    rows = rows.withColumn("seed", F.when(F.size("__in") > 0, first["kind"]).when(F.col("secret"), SECRET)).withColumn("known_as", F.when(F.size("__in") > 0, F.lower(first["value"])).otherwise(F.col("value")))
    return rows.select("doc_id", "text_hash", "value", "start", "end", "seed", "known_as", F.inline_outer("forms"))


def _within(spans: Column, start: Column, end: Column) -> Column:
    """The base spans that overlap a place."""
    return F.filter(spans, lambda s: (s["start"] < end) & (start < s["end"]))


def _added(spans: Column, words: Column, known: Column | None) -> Column:
    """Added spans of a text, given a map from sure patterns to (confidence, minus kind)."""

    def one(w: Column) -> Column:
        kind = F.when(w["secret"], F.lit(SECRET))
        if known is not None:
            best = F.array_max(F.transform(w["forms"], lambda f: F.try_element_at(known, f["pattern"])))
            kind = F.coalesce(kind, F.when(_looks_like(w["value"]), -best["minus_kind"]))
        fits = kind.isNotNull() & (w["value"] != "") & (F.size(_within(spans, w["start"], w["end"])) == 0)
        return F.when(fits, F.struct(kind.alias("kind"), w["start"].alias("start"), w["end"].alias("end")))

    return F.array_distinct(F.filter(F.transform(words, one), lambda x: x.isNotNull()))


def patterns(instances: DataFrame, rounds: int = ROUNDS, least_seeds: int = LEAST_SEEDS, least_confidence: float = LEAST_CONFIDENCE) -> DataFrame:
    """Sure patterns (pattern, kind, confidence, useful) after the rounds.

    The graph has one edge per pattern and instance with its number of
    occurrences, summed before anything is joined. A pattern is useful if an
    instance that is no seed and looks like an identifier has it.
    """
    edges = instances.where("pattern IS NOT NULL").groupBy("pattern", "words", F.col("known_as").alias("value")).agg(F.count("*").alias("n"), F.max("seed").alias("seed"))
    edges = written(edges, "pii-edges")
    seeds = edges.where("seed IS NOT NULL").select("value", F.col("seed").alias("kind")).distinct().withColumn("trust", F.lit(1.0))
    unknown = edges.where("seed IS NULL").where(_looks_like(F.col("value"))).select("pattern", "value")
    total = edges.groupBy("pattern").agg(F.sum("n").alias("total"))
    known, sure = seeds, None
    for r in range(rounds):
        hits = edges.join(known, "value").groupBy("pattern", "words", "kind").agg(F.sum(F.col("n") * F.col("trust")).alias("hit"), F.count("*").alias("different"))
        enough = hits.where(F.col("different") >= F.when(F.col("words") == 1, least_seeds * SINGLE).otherwise(least_seeds))
        scored = enough.join(total, "pattern").withColumn("confidence", F.least(F.lit(1.0), F.col("hit") / F.col("total"))).where(F.col("confidence") >= least_confidence)
        best = scored.groupBy("pattern").agg(F.max_by("kind", F.struct("confidence", -F.col("kind"))).alias("kind"), F.max("confidence").alias("confidence"))
        if r + 1 == rounds:
            best = best.join(unknown.select("pattern", F.lit(True).alias("useful")).distinct(), "pattern", "left").fillna(False, ["useful"])
        before, sure = sure, written(best, "pii-patterns")
        if before is not None:
            forget(before)
        if r + 1 < rounds:
            found = unknown.join(_small(sure), "pattern").groupBy("value", "kind").agg(F.max("confidence").alias("trust"))
            known = seeds.unionByName(found)
    forget(edges)
    return sure


def _small(sure: DataFrame) -> DataFrame:
    """The patterns, broadcast if they are few."""
    return F.broadcast(sure) if sure.count() <= BROADCAST else sure


def _looks_like(value: Column) -> Column:
    """Whether an instance that is no seed may be added: enough digits, or an @ between letters or digits."""
    return (F.length(F.regexp_replace(value, "[^0-9]", "")) >= LEAST_DIGITS) | value.rlike(r"[\p{L}0-9]@[\p{L}0-9]")


def find(documents: DataFrame, rounds: int = ROUNDS, least_seeds: int = LEAST_SEEDS, least_confidence: float = LEAST_CONFIDENCE) -> DataFrame:
    """doc_id, text_hash, base spans and added spans of every document.

    Base spans of different kinds may overlap; an added span overlaps no base
    span and has the kind of its most confident pattern, the kind that comes
    first in ``NAMES`` if several are as confident. A null text is empty. Repeated rows give repeated rows with the same
    spans, but each occurrence counts as evidence. An empty table gives no rows;
    further columns are ignored; a null doc_id stays null.
    """
    base = written(base_spans(documents), "pii-base")
    return _with_added(base, patterns(_instances(base), rounds, least_seeds, least_confidence))


def _with_added(base: DataFrame, sure: DataFrame) -> DataFrame:
    rows = _instances(base)
    place = ["doc_id", "text_hash", "start", "end"]
    new = rows.where("seed IS NULL").where(_looks_like(F.col("value"))).join(_small(sure.where("useful").select("pattern", "kind", "confidence")), "pattern")
    new = new.groupBy(*place).agg(F.max_by("kind", F.struct("confidence", -F.col("kind"))).alias("kind"))
    secrets = rows.where(F.col("seed") == SECRET).select(*place, F.lit(SECRET).alias("kind")).distinct()
    added = new.unionByName(secrets).groupBy("doc_id", "text_hash").agg(F.sort_array(F.collect_list(F.struct("kind", "start", "end"))).alias("added"))
    added = added.select(F.col("doc_id").alias("__doc"), F.col("text_hash").alias("__hash"), "added")
    out = base.join(added, base["doc_id"].eqNullSafe(added["__doc"]) & (base["text_hash"] == added["__hash"]), "left")
    return out.select(*[c for c in base.columns if c not in ("spans", "words")], _bare(F.col("spans")).alias("spans"), F.coalesce("added", F.array().cast("array<struct<kind:int,start:bigint,end:bigint>>")).alias("added"))


def _bare(spans: Column) -> Column:
    return F.transform(spans, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))


def _listed(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in NAMES])
    return F.array_join(F.transform(F.sort_array(spans), lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns of ``find``, and the numbers of added and of all spans."""
    count = lambda n: F.size(F.filter("spans", lambda s: s["kind"] == n)).cast("long")
    return found.select(
        "doc_id", *[count(n).alias(f"n_{k}") for n, k in enumerate(KINDS)],
        F.sha2(_listed(F.col("spans")), 256).alias("base_sha256"), _listed(F.concat("spans", "added")).alias("spans"),
        F.size("added").cast("long").alias("n_added"), (F.size("spans") + F.size("added")).cast("long").alias("n_spans"),
    )


def _ordered(spans: Column) -> Column:
    """Spans by start, longer ones first."""
    return F.sort_array(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("minus_end"), s["kind"].alias("kind"))))


def redact(documents: DataFrame, rounds: int = ROUNDS, least_seeds: int = LEAST_SEEDS, least_confidence: float = LEAST_CONFIDENCE) -> DataFrame:
    """The documents with every span replaced by its kind in brackets; n_chars follows the text.

    Of overlapping spans the one that starts first, then the longest, is shown;
    all of its and the others' characters go. Null texts stay null, empty ones
    empty. Repeated rows stay, each redacted alike; an empty table stays empty.
    All columns stay, whatever their names: they travel in one struct.
    """
    light = written(base_spans(documents), "pii-base")
    sure = patterns(_instances(light), rounds, least_seeds, least_confidence)
    useful = sure.where("useful")
    few = useful.select("pattern", "kind", "confidence").limit(INLINE + 1).collect() if INLINE >= 0 else None
    if few is not None and len(few) <= INLINE:
        # few patterns, as a map in the plan: texts are searched again where they are and never shuffled
        value = lambda r: F.struct(F.lit(r["confidence"]).alias("confidence"), F.lit(-r["kind"]).alias("minus_kind"))
        known = F.create_map(*[x for r in sorted(few) for x in (F.lit(r["pattern"]), value(r))]) if few else None
        based = base_spans(documents, tuple(documents.columns))
        joined = based.select("__kept", F.concat(_bare(F.col("spans")), _added(F.col("spans"), F.col("words"), known)).alias("every"))
    else:
        found = _with_added(light, sure).select(F.col("doc_id").alias("found_in"), F.col("text_hash").alias("found_hash"), F.concat("spans", "added").alias("every"))
        marks = found.where(F.size("every") > 0).dropDuplicates(["found_in", "found_hash"])
        columns = [F.col(f"`{c}`") for c in documents.columns]
        keyed = documents.select(F.struct(*columns).alias("__kept"), F.col("doc_id").alias("of"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("hash"))
        joined = keyed.join(marks, F.col("of").eqNullSafe(F.col("found_in")) & (F.col("hash") == F.col("found_hash")), "left")
    joined = joined.select("__kept", F.when(F.size("every") > 0, _ordered(F.col("every"))).alias("marks"))
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in NAMES])
    text = F.col("__kept")["text"]

    def cut(state: Column, m: Column) -> Column:
        end = -m["minus_end"]
        kept = F.substring(text, (state["at"] + 1).cast("int"), (m["start"] - state["at"]).cast("int"))
        fresh = m["start"] >= state["at"]
        return F.struct(
            F.when(fresh, F.concat(state["out"], kept, F.get(names, m["kind"]))).otherwise(state["out"]).alias("out"),
            F.greatest(state["at"], end).alias("at"),
        )

    first = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))
    shown = F.aggregate("marks", first, cut, lambda s: F.concat(s["out"], F.substring(text, (s["at"] + 1).cast("int"), F.length(text))))
    joined = joined.select("__kept", F.when(F.col("marks").isNotNull() & text.isNotNull(), shown).alias("shown"))
    types = dict(documents.dtypes)

    def final(name: str) -> Column:
        old = F.col("__kept")[name]
        if name == "text":
            old = F.coalesce("shown", old)
        elif name == "n_chars":
            old = F.when(F.col("shown").isNotNull(), F.length("shown").cast(types[name])).otherwise(old)
        return old.alias(name)

    return joined.select(*[final(c) for c in documents.columns])
