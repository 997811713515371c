"""Secret scans with column expressions alone: fixed patterns and a battery of randomness tests.

Base spans follow three patterns. Beyond them every run of at least ``LONG`` characters of the usual
encodings is a candidate. Its encoding (decimal, hexadecimal, base 32 or base 64) is inferred from its
characters, and three tests ask whether they look drawn at random from that alphabet: chi-squared for
uniform use, runs above and below the alphabet's middle, and serial correlation. The smallest of the
three p-values, times three, is the candidate's. Candidates whose randomness is rejected are words,
rulers, paths and the like; the others are secrets. The bound is set by the Benjamini-Hochberg rule
over all candidates of all documents, for each class of lengths by itself, so that at most a share
``LEVEL`` of the rejections falls on true secrets whatever the lengths are.

Positions come from the pieces between matches: their lengths and those of the matches are summed up
in blocks, so a text with very many matches takes linear time.

Null and empty texts have no spans. Rows without an id and repeated rows are rows like any other; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lettings.llm import common

LONG = 20
LEVEL = 0.05
#: The patterns, in the order of their kinds.
_KEYWORDS = "|".join(
    "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)
    for word in ("password", "passwd", "secret", "token", "api_?key")
)
ASSIGN = rf"""(?:{_KEYWORDS})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: Runs as a whole, so the least length may stand in the pattern.
ACCESS = "AKIA[A-Z0-9]{14,}"
HEX = "[0-9a-f]{16,}"
CANDIDATE = f"[A-Za-z0-9+/_=-]{{{LONG},}}"
KINDS = ("assign", "access", "hex", "random")
_UPPER, _LOWER, _DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
#: Encodings from the narrowest to the widest: what a text of theirs looks like, and the alphabet.
ENCODINGS = (
    ("^[0-9]+$", _DIGITS),
    ("^[0-9a-f]+$", _DIGITS + "abcdef"),
    ("^[0-9A-F]+$", _DIGITS + "ABCDEF"),
    ("^[A-Z2-7]+$", _UPPER + "234567"),
    ("^[A-Za-z0-9+/]+$", _UPPER + _LOWER + _DIGITS + "+/"),
    ("^.*$", _UPPER + _LOWER + _DIGITS + "-_"),
)
#: Classes of lengths, by their upper bounds, and steps per power of ten of a p-value.
LENGTHS = (32, 64)
STEPS, LAST_STEP = 8, 160
_BLOCK = 256


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _spans(text: str, pattern: str) -> str:
    """SQL for the matches of a pattern: ``s``, ``e`` (code points, end exclusive) and ``m``."""
    quoted = _quoted(pattern)
    found = f"""transform(array(named_struct(
        'pieces', split({text}, {quoted}, -1), 'matches', regexp_extract_all({text}, {quoted}, 0))), p ->
      transform(sequence(0, size(p.matches) - 1), i ->
        named_struct('gap', length(p.pieces[i]), 'm', p.matches[i])))[0]"""
    # The pieces of text before a match are summed up per block, then within the block.
    blocks = f"""transform(sequence(0, int(ceil(size(f) / {_BLOCK})) - 1), b -> slice(f, b * {_BLOCK} + 1, {_BLOCK}))"""
    size = "x -> x.gap + length(x.m)"
    placed = f"""flatten(transform(array({found}), f ->
      flatten(transform(array({blocks}), bs ->
        flatten(transform(array(transform(bs, b -> aggregate(transform(b, {size}), 0, (a, x) -> a + x))), sums ->
          flatten(transform(bs, (b, n) ->
            flatten(transform(array(aggregate(slice(sums, 1, n), 0, (a, x) -> a + x)), before ->
              transform(b, (x, i) -> named_struct(
                's', before + x.gap + aggregate(transform(slice(b, 1, i), {size}), 0, (a, y) -> a + y),
                'm', x.m))))))))))))"""
    return f"""transform({placed}, x -> named_struct('s', x.s, 'e', x.s + length(x.m), 'm', x.m))"""


_NONE = "cast(array() as array<struct<s:int,e:int,m:string>>)"


def _found(text: str, pattern: str, kept: str = "true") -> Column:
    """Matches that pass, none where the text has no match: most texts are read once only."""
    spans = f"filter({_spans(text, pattern)}, x -> {kept})"
    return F.expr(f"if({text} rlike {_quoted(pattern)}, {spans}, {_NONE})")


def _normal_tail(z: str) -> str:
    """Chance that a normal variable exceeds ``z``, by a logistic curve (error below 0.0002)."""
    return f"(1 / (1 + exp(least(700D, 1.5976D * {z} + 0.07056D * power({z}, 3)))))"


def _symbols(text: str, alphabet: str) -> str:
    return f"transform(filter(split({text}, ''), c -> c != ''), c -> locate(c, {alphabet}))"


def with_p_value(candidates: DataFrame) -> DataFrame:
    """Add ``p``, the chance of so uneven or regular a string at random, to rows with ``m``."""
    bare = F.regexp_replace("m", "=+$", "")
    alphabet = F.lit(ENCODINGS[-1][1])
    for shape, letters in reversed(ENCODINGS[:-1]):
        alphabet = F.when(F.col("bare").rlike(shape), F.lit(letters)).otherwise(alphabet)
    return (
        candidates.withColumn("bare", bare)
        .withColumn("alphabet", alphabet)
        .withColumn("v", F.expr(_symbols("bare", "alphabet")))
        .withColumn("k", F.length("alphabet").cast("double"))
        .withColumn("n", F.size("v").cast("double"))
        .withColumn(
            "squares",
            F.expr(
                "aggregate(sequence(1, int(k)), 0D, (a, s) -> "
                "a + power(length(bare) - length(replace(bare, substr(alphabet, s, 1), '')), 2))"
            ),
        )
        .withColumn("high", F.expr("transform(v, x -> if(x > k / 2, 1, 0))"))
        .withColumn("n1", F.expr("cast(aggregate(high, 0, (a, x) -> a + x) as double)"))
        .withColumn("mean", F.expr("aggregate(v, 0D, (a, x) -> a + x) / greatest(n, 1)"))
        .withColumn("steps", F.expr("zip_with(slice(v, 1, greatest(size(v) - 1, 0)), slice(v, 2, size(v)), (x, y) -> named_struct('x', x, 'y', y))"))
        .withColumn("turns", F.expr("aggregate(steps, 0D, (a, s) -> a + if((s.x > k / 2) != (s.y > k / 2), 1, 0))"))
        .withColumn("joint", F.expr("aggregate(steps, 0D, (a, s) -> a + (s.x - mean) * (s.y - mean))"))
        .withColumn("own", F.expr("aggregate(v, 0D, (a, x) -> a + (x - mean) * (x - mean))"))
        # Wilson and Hilferty's cube root makes chi-squared nearly normal.
        .withColumn("chi", F.expr("squares * k / greatest(n, 1) - n"))
        .withColumn("f", F.expr("2 / (9 * (k - 1))"))
        .withColumn("z1", F.expr("(power(greatest(chi, 0) / (k - 1), 1 / 3D) - (1 - f)) / sqrt(f)"))
        .withColumn("runs", F.expr("2 * n1 * (n - n1) / greatest(n, 1) + 1"))
        .withColumn("spread", F.expr("greatest((runs - 1) * (runs - 2) / greatest(n - 1, 1), 0.25)"))
        .withColumn("z2", F.expr("abs(turns + 1 - runs) / sqrt(spread)"))
        .withColumn("z3", F.expr("if(own > 0, abs(joint / own + 1 / n) * sqrt(n), 40)"))
        .withColumn(
            "p",
            F.expr(
                f"least(1D, 3 * least({_normal_tail('z1')}, 2 * {_normal_tail('z2')}, 2 * {_normal_tail('z3')}))"
            ),
        )
    )


def _class_of_length(length: str) -> Column:
    found = F.lit(len(LENGTHS))
    for number, bound in reversed(list(enumerate(LENGTHS))):
        found = F.when(F.expr(length) < bound, F.lit(number)).otherwise(found)
    return found


def bounds(candidates: DataFrame, level: float = LEVEL) -> DataFrame:
    """For each class of lengths the p-value up to which randomness is rejected.

    P-values are counted in steps (eight to a power of ten), which are few whatever the data; a
    step's upper end stands for its values, so the level is kept.
    """
    step = F.least(F.floor(-F.log10(F.greatest("p", F.lit(1e-30))) * STEPS), F.lit(LAST_STEP))
    counted = candidates.groupBy("class", step.alias("step")).agg(F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy("class")
    upwards = whole.orderBy(F.desc("step")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = counted.select(
        "class",
        F.pow(F.lit(10.0), -F.col("step") / STEPS).alias("upper"),
        F.sum("n").over(upwards).alias("up_to"),
        F.sum("n").over(whole).alias("all"),
    )
    rejected = F.col("upper") * F.col("all") <= level * F.col("up_to")
    return ranked.groupBy("class").agg(F.max(F.when(rejected, F.col("upper"))).alias("bound"))


def scanned(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and the spans of every row: ``base`` by pattern, ``random`` by the battery."""
    common.prepare(documents.sparkSession)
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = documents.select(F.col(key).alias("key"), whole.alias("text"))
    value = f"length(regexp_extract(x.m, {_quoted(ASSIGN)}, 1)) >= 12"
    found = rows.select(
        "key",
        _found("text", ASSIGN, value).alias("assign"),
        _found("text", ACCESS).alias("access"),
        _found("text", HEX).alias("hex"),
        _found("text", CANDIDATE).alias("candidates"),
    )
    apart = " and ".join(
        f"not exists({kind}, b -> b.s < c.e and c.s < b.e)" for kind in ("assign", "access", "hex")
    )
    stored = common.stored(
        found.select(
            "key",
            *[F.expr(f"transform({k}, x -> named_struct('s', x.s, 'e', x.e))").alias(k) for k in KINDS[:3]],
            F.expr(f"filter(candidates, c -> {apart})").alias("candidates"),
        ).withColumn("row", F.monotonically_increasing_id()),
        "spans",
    )
    candidates = stored.select("row", F.explode("candidates").alias("c")).select(
        "row", "c.s", "c.e", "c.m", _class_of_length("c.e - c.s").alias("class")
    )
    tested = common.stored(with_p_value(candidates).select("row", "s", "e", "class", "p"), "tested")
    # One row per class of lengths.
    kept = tested.join(F.broadcast(bounds(tested)), "class").filter("bound is null or p > bound")
    random = kept.groupBy("row").agg(F.collect_list(F.struct("s", "e")).alias("random"))
    return stored.drop("candidates").join(random, "row", "left").select(
        "key", *KINDS[:3], F.coalesce("random", F.expr("cast(array() as array<struct<s:int,e:int>>)")).alias("random")
    )


def _listed(kinds: tuple[str, ...]) -> str:
    """Spans of some kinds as text, by start and then by kind."""
    marked = ", ".join(
        f"transform({kind}, x -> named_struct('s', x.s, 'k', {number}, 'e', x.e, 'n', '{kind}'))"
        for number, kind in enumerate(kinds)
    )
    return (
        f"concat_ws(',', transform(array_sort(concat({marked})), "
        "x -> concat(x.n, ':', x.s, ':', x.e)))"
    )


def digest(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The query's columns."""
    return scanned(documents, key, text).select(
        F.col("key").alias(key),
        *[F.size(kind).cast("long").alias(f"n_{kind}") for kind in KINDS[:3]],
        F.expr(f"sha2({_listed(KINDS[:3])}, 256)").alias("base_sha256"),
        F.expr(_listed(KINDS)).alias("spans"),
        F.size("random").cast("long").alias("n_random"),
    )
