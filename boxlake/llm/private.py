"""Personal data: base patterns, and contextual extraction bootstrapped from what they find.

Base matches are the seeds. An instance (a seed, or a word that looks like an identifier) stands in lexical patterns: the
word before it, the two words before it, the word after it. Each round scores the pattern-instance table: a pattern's
confidence is the weight of the known instances that it stands by, over all its occurrences in the corpus; a pattern that
is confident and has several instances gives its other instances a score, one minus the product of its doubts, and these
count as known in the next round, so that they induce patterns that no seed stands by. What confident patterns stand by at
the end, and no base pattern covers, is marked. All of it is DataFrame and SQL expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxlake.llm.common import free_names, let
from boxlake.session import Scratch, size_bytes, written

KINDS = ("email", "ip", "card", "phone", "context")
#: The base patterns, with possessive repeats and look-behinds that keep matching linear and change no match.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
IP_OK = r"^0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])(?:\.0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])){3}$"
GAP, WORD = r"[\x20\x09-\x0D]", r"[^\x20\x09-\x0D]"
#: A word with a digit or an at sign, or what follows a label's colon or equals sign in such a word.
CANDIDATE = r"(?:(?<![^\x20\x09-\x0D])|(?<=[A-Za-z_][:=]))[^\x20\x09-\x0D0-9@:=]*+[0-9@][^\x20\x09-\x0D]*+"
#: A label's end, where the label counts as a word of its own.
GLUED = r"([A-Za-z_][:=])(?=[^\x20\x09-\x0D])"
#: Characters of context on either side.
NEAR = 64
SPAN = "struct<kind:string,start:int,end:int,value:string,l1:string,l2:string,r1:string>"
#: Elements that a running sum takes at a time: copies grow with this, not with the number of elements.
BLOCK = 256
#: Broadcast a table up to this size; beyond it, a shuffle joins.
BROADCAST_BYTES = 8 << 20


def running(values: Column, op, start) -> Column:
    """For each element of an array of one or more ints, ``op`` over those before it, from ``start``; near linear in time."""

    def before(part: Column, first: Column) -> Column:
        zero = F.struct(first.alias("at"), F.array().cast("array<int>").alias("out"))
        return F.aggregate(part, zero, lambda a, x: F.struct(op(a["at"], x).alias("at"), F.concat(a["out"], F.array(a["at"])).alias("out")), lambda a: a["out"])

    def blocks(x: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.floor((F.size(x) - 1) / BLOCK).cast("int")), lambda b: F.slice(x, b * BLOCK + 1, BLOCK))

    totals = lambda cut: F.transform(cut, lambda part: F.aggregate(part, F.lit(start), lambda a, x: op(a, x)))
    return let(values, lambda x: let(blocks(x), lambda cut: F.flatten(F.zip_with(cut, before(totals(cut), F.lit(start)), before))))


def _words_near(p: Column, m: Column, i: Column) -> list[Column]:
    """Patterns of match i, given the pieces p between the matches m: (l1, l2, r1), null where there is no whole word.

    Up to NEAR characters on each side are read, and never a word that they cut.
    """
    take = lambda a, k: F.right(F.get(a, k), F.lit(NEAR + 1))
    said = F.concat_ws("", take(p, i - 2), take(m, i - 2), take(p, i - 1), take(m, i - 1), take(p, i))
    whole = (i <= 2) & (F.length(said) <= NEAR)
    left = F.regexp_replace(F.right(said, F.lit(NEAR)), r"""["'(\[<{]+$""", "")
    left = F.regexp_replace(left, r"([A-Za-z_][:=])(?=[^\x20\x09-\x0D]|$)", "$1 ")
    left = F.when(whole, F.concat(F.lit(" "), left)).otherwise(left)
    right = F.regexp_replace(F.left(F.concat_ws("", F.left(F.get(p, i + 1), F.lit(NEAR)), F.left(F.get(m, i + 1), F.lit(NEAR)), F.left(F.get(p, i + 2), F.lit(NEAR))), F.lit(NEAR)), GLUED, "$1 ")
    plain = lambda c: F.regexp_replace(F.lower(F.regexp_replace(c, f"{GAP}+", " ")), "[0-9]+", "#")
    some = lambda c, mark: F.when(c != "", F.concat(F.lit(mark), plain(c)))
    one = F.regexp_extract(left, f"(?<={GAP})({WORD}+){GAP}+$", 1)
    two = F.regexp_extract(left, f"(?<={GAP})({WORD}+{GAP}+{WORD}+){GAP}+$", 1)
    after = F.regexp_extract(right, f"^[^\\x20\\x09-\\x0DA-Za-z0-9]*{GAP}+({WORD}+)(?={GAP})", 1)
    return [some(one, "<").alias("l1"), some(two, "<<").alias("l2"), some(after, ">").alias("r1")]


def _matches(text: Column, pattern: str, kind: str, valid=None) -> Column:
    """Array of SPAN: the pieces between matches and the matches give the positions, in code points."""

    def spans(x: Column) -> Column:
        p, m = x["p"], x["m"]
        sums = running(F.zip_with(p, m, lambda a, b: F.length(a) + F.coalesce(F.length(b), F.lit(0))), lambda a, b: a + b, 0)

        def one(at: Column):
            start = lambda i: F.get(at, i) + F.length(F.get(p, i))
            return lambda v, i: F.struct(F.lit(kind).alias("kind"), start(i).alias("start"), (start(i) + F.length(v)).alias("end"), v.alias("value"), *_words_near(p, m, i)).cast(SPAN)

        # Matches that fail drop out before their surroundings are read.
        made = let(sums, lambda at: F.transform(m, one(at)))
        return made if valid is None else F.filter(made, lambda s: valid(s["value"]))

    return let(F.struct(F.split(text, pattern, -1).alias("p"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m")), spans)


def _luhn(digits: Column) -> Column:
    total = F.aggregate(F.transform(F.split(F.reverse(digits), ""), lambda c, i: _doubled(F.coalesce(F.try_to_number(c, F.lit("9")).cast("int"), F.lit(0)), i)), F.lit(0), lambda a, x: a + x)
    return total % 10 == 0


def _doubled(d: Column, i: Column) -> Column:
    return F.when(i % 2 == 0, d).otherwise(F.when(d > 4, 2 * d - 9).otherwise(2 * d))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _none() -> Column:
    return F.array().cast(f"array<{SPAN}>")


def base_spans(text: Column) -> Column:
    """Array of SPAN by kind as listed, then start. A kind is looked for only where its characters occur."""
    digit = text.rlike("[0-9]")
    card = lambda v: F.when(F.length(_digits(v)).between(16, 19), _luhn(_digits(v))).otherwise(False)
    return F.concat(
        F.when(F.contains(text, F.lit("@")), _matches(text, EMAIL, "email")).otherwise(_none()),
        F.when(digit & text.rlike(r"[0-9]\.[0-9]++\.[0-9]"), _matches(text, IP, "ip", lambda v: v.rlike(IP_OK))).otherwise(_none()),
        F.when(digit & text.rlike(CARD), _matches(text, CARD, "card", card)).otherwise(_none()),
        F.when(digit & F.contains(text, F.lit("+")), _matches(text, PHONE, "phone", lambda v: F.length(_digits(v)).between(8, 15))).otherwise(_none()),
    )


def _covered(base: Column, cands: Column) -> Column:
    """For each candidate, in order, whether a base span overlaps it. Both are swept once, in order of their starts."""
    event = lambda s, cand: F.struct(s["start"].alias("start"), F.lit(cand).alias("cand"), s["end"].alias("end"))
    events = F.sort_array(F.concat(F.transform(base, lambda s: event(s, 0)), F.transform(cands, lambda s: event(s, 1))))
    far = 2**31 - 1

    def sweep(e: Column) -> Column:
        reach = running(F.transform(e, lambda s: F.when(s["cand"] == 0, s["end"]).otherwise(0)), F.greatest, 0)
        ahead = running(F.reverse(F.transform(e, lambda s: F.when(s["cand"] == 0, s["start"]).otherwise(far))), F.least, far)
        hit = F.zip_with(F.zip_with(e, reach, lambda s, r: F.struct(s["cand"].alias("cand"), s["end"].alias("end"), (r > s["start"]).alias("hit"))), F.reverse(ahead), lambda s, a: F.struct(s["cand"].alias("cand"), (s["hit"] | (a < s["end"])).alias("hit")))
        return F.transform(F.filter(hit, lambda s: s["cand"] == 1), lambda s: s["hit"])

    return let(events, sweep)


def _open(text: Column, base: Column, least_digits: int) -> Column:
    """Candidates that no base span overlaps and that look like identifiers, their ends trimmed: array of SPAN."""

    def trimmed(c: Column) -> Column:
        lead = F.length(F.regexp_extract(c["value"], r"^[^A-Za-z0-9@+]+", 0))
        value = F.regexp_replace(c["value"], r"^[^A-Za-z0-9@+]+|[^A-Za-z0-9]+$", "")
        return F.struct(c["kind"], (c["start"] + lead).alias("start"), (c["start"] + lead + F.length(value)).alias("end"), value.alias("value"), c["l1"], c["l2"], c["r1"]).cast(SPAN)

    def like(c: Column) -> Column:
        n = F.length(_digits(c["value"]))
        return F.contains(c["value"], F.lit("@")) | (n >= least_digits) | ((n >= 2) & (F.length(c["value"]) >= 5) & c["value"].rlike("[A-Za-z]"))

    def free(cands: Column) -> Column:
        return F.when(F.size(cands) == 0, _none()).otherwise(let(_covered(base, cands), lambda hit: F.filter(F.transform(F.filter(cands, lambda c, i: ~F.get(hit, i)), trimmed), like)))

    return F.when(text.rlike("[0-9@]"), let(_matches(text, CANDIDATE, "context"), free)).otherwise(_none())


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if size_bytes(df) <= BROADCAST_BYTES else df


def _found(docs: DataFrame, text_col: str, least_digits: int, keep: dict[str, Column]) -> DataFrame:
    """(keep..., _t1, _t2, _base, _open, _seen) of each row; _t1 and _t2 are hashes of the text; no text among them."""
    text = F.coalesce(F.col(text_col), F.lit(""))

    def both(t: Column) -> Column:
        return let(base_spans(t), lambda base: F.struct(base.alias("base"), _open(t, base, least_digits).alias("open")))

    # A generator computes the spans once, whatever is filtered above.
    rows = docs.select(*[c.alias(k) for k, c in keep.items()], F.xxhash64(text).alias("_t1"), F.xxhash64(text, F.lit(1)).alias("_t2"), F.explode_outer(F.array(let(text, both))).alias("_f"))
    place = lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))
    seen = lambda s: F.struct(F.filter(F.array(s["l1"], s["l2"], s["r1"]), lambda p: p.isNotNull()).alias("ps"), F.xxhash64(s["value"]).alias("v"), (s["kind"] != "context").alias("seed"), s["start"].alias("start"), s["end"].alias("end"))
    return rows.select(*keep, "_t1", "_t2", F.transform("_f.base", place).alias("_base"), F.transform(F.concat("_f.base", "_f.open"), seen).alias("_seen"))


def _good(docs: DataFrame, rows: DataFrame, text_col: str, least_conf: float, least_seeds: int, rounds: int, scratch: Scratch) -> DataFrame | None:
    """(p): the patterns that are confident after the rounds; None if there are none."""
    edges = rows.select(F.explode("_seen").alias("s")).select(F.explode("s.ps").alias("p"), "s.v", "s.seed").groupBy("p", "v", "seed").agg(F.count(F.lit(1)).alias("n"))
    edges = scratch.written(edges, "edges")
    able = scratch.written(edges.groupBy("p").agg(F.count(F.lit(1)).alias("m"), F.max("seed").alias("seed")).filter(F.col("m") >= least_seeds), "able")
    # Without a pattern that seeds induce, no other can follow.
    if able.filter("seed").isEmpty():
        return None
    # Every occurrence of a pattern in the corpus counts, whatever stands by it.
    text = F.coalesce(F.col(text_col), F.lit(""))
    glued = F.when(F.contains(text, F.lit(":")) | F.contains(text, F.lit("=")), F.regexp_replace(text, GLUED, "$1 ")).otherwise(text)
    said = docs.select(F.split(F.regexp_replace(F.lower(glued), "[0-9]+", "#"), f"{GAP}+").alias("w"))
    pairs = said.select(F.explode(F.arrays_zip("w", F.concat(F.array(F.lit(None).cast("string")), "w").alias("b"))).alias("x")).select("x.w", "x.b").filter("w is not null")
    last = scratch.written(able.select(F.element_at(F.split(F.regexp_replace("p", "^(<<|<|>)", ""), " "), -1).alias("w")).distinct(), "last")
    # Of the word before, only those count apart that stand in a pattern of two words.
    two = able.filter(F.startswith("p", F.lit("<<"))).select(F.split(F.substring("p", 3, 1 << 30), " ").alias("x")).select(F.col("x")[0].alias("b"), F.col("x")[1].alias("w"), F.lit(True).alias("both"))
    counts = pairs.join(_small(last), "w", "left_semi").join(_small(scratch.written(two, "two")), ["w", "b"], "left").groupBy("w", F.when(F.col("both"), F.col("b")).alias("b")).agg(F.count(F.lit(1)).alias("n"))
    totals = counts.select(F.explode(F.array(F.concat(F.lit("<"), "w"), F.concat(F.lit(">"), "w"), F.concat(F.lit("<<"), "b", F.lit(" "), "w"))).alias("p"), "n").filter("p is not null").groupBy("p").agg(F.sum("n").alias("all"))
    able = scratch.written(able.select("p").join(totals, "p"), "totals")
    edges = scratch.written(edges.join(_small(able.select("p")), "p", "left_semi"), "edges")
    sure = scratch.written(edges.filter("seed").groupBy("p").agg(F.count(F.lit(1)).alias("k"), F.sum("n").cast("double").alias("w")), "seeds")
    rest = edges.filter("not seed")
    known, good, size = None, None, 0
    for _ in range(rounds):
        weights = sure
        if known is not None:
            weights = sure.unionByName(rest.join(_small(known), "v").groupBy("p").agg(F.count(F.lit(1)).alias("k"), F.sum(F.col("n") * F.col("s")).alias("w"))).groupBy("p").agg(F.sum("k").alias("k"), F.sum("w").alias("w"))
        conf = F.least(F.lit(1.0), F.col("w") / F.col("all"))
        good = scratch.written(weights.filter(F.col("k") >= least_seeds).join(_small(able), "p").select("p", conf.alias("conf")).filter(F.col("conf") >= least_conf), "good")
        before, size = size, good.count()
        if size in (0, before):
            break
        known = scratch.written(rest.join(_small(good), "p").groupBy("v").agg((1 - F.exp(F.sum(F.log(1.000001 - F.col("conf"))))).alias("s")), "known")
    return good.select("p") if size else None


def _context(rows: DataFrame, good: DataFrame, *keys: str) -> DataFrame:
    """(keys..., _new): what confident patterns mark in each row that has any, by start."""
    open_ = rows.select(*keys, F.explode(F.filter("_seen", lambda s: ~s["seed"])).alias("s")).select(*keys, "s.start", "s.end", F.explode("s.ps").alias("p"))
    hits = open_.join(_small(good), "p", "left_semi").groupBy(*keys).agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("hits"))
    return hits.select(*keys, F.transform("hits", lambda h: F.struct(F.lit("context").alias("kind"), h["start"].alias("start"), h["end"].alias("end"))).alias("_new"))


def find_private(docs: DataFrame, least_conf: float = 0.5, least_seeds: int = 5, least_digits: int = 5, rounds: int = 4, id_col: str = "doc_id", text_col: str = "text", keep: list[str] = ()) -> DataFrame:
    """(id, n_email, n_ip, n_card, n_phone, n_context, base_sha256, spans, all_spans, keep...) of every whole text.

    all_spans: array of (kind, start, end), by kind as listed, then start; positions are code points, the end exclusive.
    A pattern needs ``least_seeds`` different instances and a confidence of ``least_conf``; a word that it marks overlaps no
    base span, and has an at sign, ``least_digits`` digits, or letters and two digits among five characters or more. Null
    and empty texts have no spans; repeated rows give repeated rows and count as often as they stand; no rows give no rows.
    Columns of ``keep`` pass through, others are not read.
    """
    scratch = Scratch(docs.sparkSession)
    rows = _found(docs, text_col, least_digits, {"_id": F.col(id_col), **{f"_keep_{c}": F.col(c) for c in keep}})
    # Row numbers are fixed by writing them.
    rows = written(rows.withColumn("_r", F.monotonically_increasing_id()), "private")
    good = _good(docs, rows, text_col, least_conf, least_seeds, rounds, scratch)
    every = F.col("_base")
    out = rows
    if good is not None:
        new = written(_context(rows, good, "_r"), "context")
        out = rows.join(_small(new), "_r", "left")
        every = F.when(F.col("_new").isNull(), F.col("_base")).otherwise(F.concat("_base", "_new"))
    scratch.clear()
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    n = lambda kind: F.size(F.filter(every, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return out.select(F.col("_id").alias(id_col), *[n(k) for k in KINDS], F.sha2(joined(F.col("_base")), 256).alias("base_sha256"), joined(every).alias("spans"), every.alias("all_spans"), *[F.col(f"_keep_{c}").alias(c) for c in keep])


def redact_private(docs: DataFrame, least_conf: float = 0.5, least_seeds: int = 5, least_digits: int = 5, rounds: int = 4, text_col: str = "text") -> DataFrame:
    """All columns of ``docs``, with what ``find_private`` finds in the text replaced by its kind in brackets.

    Texts are never written or moved: the patterns come from a narrow table, then base spans are found again beside the
    text, and the few texts with contextual spans are met by two hashes of the text. A null text stays null.
    """
    scratch = Scratch(docs.sparkSession)
    rows = scratch.written(_found(docs, text_col, least_digits, {}).filter(F.size("_seen") > 0), "private")
    good = _good(docs, rows, text_col, least_conf, least_seeds, rounds, scratch)
    text = F.col(text_col)
    if good is None:
        scratch.clear()
        return docs.withColumn(text_col, let(text, lambda t: redacted(t, base_spans(t))))
    new = written(_context(rows.dropDuplicates(["_t1", "_t2"]), good, "_t1", "_t2"), "context")
    scratch.clear()
    t1, t2, added = free_names(docs, "_t1", "_t2", "_new")
    here = docs.withColumns({t1: F.xxhash64(text), t2: F.xxhash64(text, F.lit(1))})
    new = new.select(F.col("_t1").alias(t1), F.col("_t2").alias(t2), F.col("_new").alias(added))
    bare = lambda t: F.transform(base_spans(t), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    marked = here.join(_small(new), [t1, t2], "left")
    none = F.array().cast("array<struct<kind:string,start:int,end:int>>")
    return marked.withColumn(text_col, let(text, lambda t: redacted(t, F.concat(bare(t), F.coalesce(F.col(added), none))))).select(*docs.columns)


def redacted(text: Column, spans: Column) -> Column:
    """The text with each span, overlapping ones as one, replaced by its kind in brackets. Near linear in text and spans."""
    ordered = F.sort_array(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))

    def parts(o: Column) -> Column:
        reach = running(F.transform(o, lambda s: s["end"]), F.greatest, 0)
        apart = F.filter(F.zip_with(o, reach, lambda s, r: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), r.alias("after"))), lambda s: s["start"] >= s["after"])
        end = F.aggregate(o, F.lit(0), lambda a, s: F.greatest(a, s["end"]))
        return let(apart, lambda a: F.concat(F.array_join(F.flatten(F.transform(F.sequence(F.lit(0), F.floor((F.size(a) - 1) / BLOCK).cast("int")), lambda b: _block(text, F.slice(a, b * BLOCK + 1, BLOCK)))), ""), F.substring(text, end + 1, F.length(text))))

    return F.when(F.size(spans) > 0, let(ordered, parts)).otherwise(text)


def _block(text: Column, part: Column) -> Column:
    """Strings that stand for the text up to the end of a block of spans; the block's text is cut out first."""
    first, last = part[0]["after"], F.element_at(part, -1)["start"]
    piece = lambda s, here: F.concat(F.substring(here, s["after"] - first + 1, s["start"] - s["after"]), F.lit("["), F.upper(s["kind"]), F.lit("]"))
    return let(F.substring(text, first + 1, last - first), lambda here: F.transform(part, lambda s: piece(s, here)))
