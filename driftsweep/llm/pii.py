"""Personal data by candidate gradient boosting, with DataFrame functions only.

Base spans, leftmost and non-overlapping for each kind (code points, end exclusive):
  email  [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+
  ip     [0-9]+(\\.[0-9]+)(\\.[0-9]+)(\\.[0-9]+), each part at most 255
  card   [0-9]([\\x20-]?[0-9])+ with 14 to 19 digits that pass Luhn
  phone  \\+[0-9][\\x20().0-9-]+[0-9] with 10 to 15 digits
Base spans are always kept. The patterns run in possessive form with anchored starts, which match
the same spans in time linear in the text.

Candidates. Wider generators propose further, possibly overlapping spans (masked at-signs and dots,
other separators, IPv6, numbers without a plus); a span that fails the check of its kind is none. Format
and context features of a span form a cell of at most ``CELLS`` values. For each kind boosted trees are
fitted on the cell counts of the *whole* corpus: base matches that pass their check are positive, matches
of near-miss generators (addresses without a domain, versions and times, other groups of digits) are
negative. What tells the two apart (a plus, the dots, the grouping, the check) is no feature, so size,
separators, cue words and neighbours must predict it. Documents with crc32(doc_id) mod 5 = 0 are held
out and calibrate the scores (isotonic, by kind). A candidate is added if its cell's calibrated
probability is at least ``PRECISION``, positive training matches of its kind were seen beside the same cue and
the same kinds of neighbours (trees say nothing of contexts never seen), and it overlaps no base span and
no better candidate (higher probability, then earlier, then longer). Equal gains go to the first test.

Null and empty texts have no spans; a very long text is one row like any other. Repeated rows give equal
results; an empty table gives none; other columns are ignored. No row is shuffled; only cell counts are.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftsweep.llm.common import cut, ready

KINDS = ("email", "ip", "card", "phone")
PRECISION, ROUNDS, RATE, HELD_OUT = 0.95, 30, 0.3, 5
#: Sizes of the features: kind, digits, separators, cue word, left and right neighbour, one digit only.
RADIX = (4, 8, 3, 3, 3, 3, 2)
#: Places of the features that are context.
CONTEXT = (3, 4, 5)
CELLS = math.prod(RADIX)
_BLOCK = 256

#: (kind, what a text must hold, pattern) of the base matches and of the wider generators, by kind.
BASE = (
    (0, "@", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
    (1, ".", r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"),
    (2, None, r"[0-9](?:[\x20-]?[0-9])++"),
    (3, "+", r"\+[0-9][\x20().0-9-]+[0-9]"),
)
WIDE = (
    (0, "at", r"(?i)(?<![a-z0-9._%+-])[a-z0-9._%+-]{1,64}+\x20?[\[({]at[\])}]\x20?[a-z0-9-]{1,63}+(?:\x20?(?:\.|[\[({]dot[\])}])\x20?[a-z0-9-]{2,63}+){1,5}"),
    (1, ":", r"(?i)(?<![0-9a-f:])[0-9a-f]{1,4}+(?::[0-9a-f]{1,4}+){7}(?![0-9a-f:])"),
    (2, None, r"(?<![0-9])[0-9]{4}(?:[._/\x20-]{1,2}[0-9]{4}){3}(?![0-9])"),
    (3, None, r"(?<![0-9(+])(?:00[1-9][0-9]{0,2}[\x20.-])?\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])"),
)
#: Matches like those of BASE that are something else, unless ``_passes`` knows better.
NEAR = (
    (0, "@", r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]*+(?!\.[A-Za-z0-9-])"),
    (1, None, r"(?i)(?<![0-9.:])[0-9]{1,5}+(?:\.[0-9]{1,5}+){1,2}(?!\.?[0-9])|(?<![0-9a-f:])[0-9a-f]{1,4}+(?::[0-9a-f]{1,4}+){1,6}(?![0-9a-f:])"),
    (2, None, r"(?<![0-9])[0-9]{1,9}+(?:[._/:,][\x20]?[0-9]{1,9}+){1,6}(?![0-9])"),
    (3, None, r"\+[0-9][\x20().0-9-]+[0-9]|(?<![0-9(])\(?[0-9]{1,9}+\)?(?:[\x20./-][0-9]{1,9}+){1,5}(?![0-9])"),
)
#: Words that announce personal data, or another number, when they stand just before it.
CUES = r"(?i)(?:mail|contact|phone|tel|call|fax|mobile|card|visa|account|iban|ip|addr|address|host)(?:\x20(?:no|nr|number))?[^\p{L}]{0,4}$"
COUNTERS = r"(?i)(?<!\p{L})(?:order|invoice|ref|item|version|serial|sku|isbn|page|part|case|ticket|batch|lot)(?:\x20(?:no|nr|number))?[^\p{L}]{0,4}$"


def _luhn(d: Column) -> Column:
    """Luhn sum of a string of digits is a multiple of ten."""
    n = F.length(d)
    each = F.transform(F.sequence(F.lit(1), n), lambda i: F.substr(d, i, F.lit(1)).cast("int")
                       * F.when((n - i) % 2 == 1, 2).otherwise(1))
    return F.aggregate(each, F.lit(0), lambda a, x: a + F.when(x > 9, x - 9).otherwise(x)) % 10 == 0


def _octets(s: Column) -> Column:
    """All dotted parts are at most 255, leading zeros aside."""
    return ~s.rlike(r"(?:^|\.)0*(?:[1-9][0-9]{3,}|[3-9][0-9]{2}|2[6-9][0-9]|25[6-9])(?:\.|$)")


def _passes(i: Column, x: Column) -> Column:
    """The check of match ``x`` of pattern ``i`` (base, then wide, then near ones: true if it is no near miss)."""
    wide, near = len(BASE), len(BASE) + len(WIDE)
    return (F.when(i == 0, F.lit(True)).when(i == wide, x["s"].rlike(r"[.)\]}\x20][A-Za-z]{2,}$"))
            .when(i == 1, _octets(x["s"])).when(i == wide + 1, F.lit(True))
            .when(i == near + 2, ~x["n"].between(12, 19) | x["s"].rlike(WIDE[2][2]))
            .when(i == near + 3, ~x["n"].between(7, 18) | x["s"].rlike(r"^\+|" + WIDE[3][2]))
            .when(i >= near, F.lit(False))
            .when(i % 4 == 2, F.when(x["n"].between(14, 19), _luhn(x["d"])).otherwise(False))
            .otherwise(x["n"].between(10, 15)))


def _cell(kind: Column, x: Column) -> Column:
    """Features of a checked match as one number below CELLS."""
    n = x["n"]
    size = F.when(n == 0, 0).when(n < 7, 1).when(n < 10, 2).when(n < 12, 3).when(n < 14, 4).when(n < 16, 5).when(n < 20, 6).otherwise(7)
    inner = F.translate(x["seps"], "+()", "")    # a plus is the label's, brackets go with spaces
    one_kind = F.length(F.replace(inner, F.left(inner, F.lit(1)), F.lit(""))) == 0
    seps = F.when(inner == "", 0).when(one_kind, 1).otherwise(2)
    side = lambda c: F.when((c == "") | c.rlike(r"\s"), 0).when(c.rlike(r"[\p{L}\p{N}]"), 2).otherwise(1)
    same = (n > 1) & (F.length(F.replace(x["d"], F.left(x["d"], F.lit(1)), F.lit(""))) == 0)
    code = kind
    cue = F.when(x["before"].rlike(CUES), 1).when(x["before"].rlike(COUNTERS), 2).otherwise(0)
    for base, f in zip(RADIX[1:], (size, seps, cue, side(F.right(x["before"], F.lit(1))), side(x["after"]), same.cast("int")), strict=True):
        code = code * base + F.coalesce(f, F.lit(0))
    return code.cast("int")


def _fields(x: Column, *names: str) -> list[Column]:
    return [x[n].alias(n) for n in names]


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id, base, wide, near: arrays of (start, kind, end, cell, passes) for every row of docs (doc_id, text).

    Every step is an array with one entry for each pattern. Starts come from the gaps between matches:
    the lengths of a pattern's gaps and matches are summed in blocks (n^1.5 steps for n matches), so a
    text full of matches stays cheap.
    """
    patterns, text = BASE + WIDE + NEAR, F.col("text")
    none = F.array().cast("array<string>")

    def possible(needs):
        return text.rlike("[0-9]") if needs is None else F.contains(text, F.lit(needs))

    def each(column, make):  # nested: the matches of each pattern
        return F.transform(column, lambda own, i: F.transform(own, lambda x, j: make(x, i, j)))

    total = lambda a: F.aggregate(a, F.lit(0).cast("long"), lambda x, y: x + y)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.select("doc_id", "text", *[
        F.when(possible(needs), F.regexp_extract_all(text, F.lit(p), F.lit(0))).otherwise(none).alias(f"m{i}")
        for i, (_, needs, p) in enumerate(patterns)])
    rows = rows.select("doc_id", F.array(*[f"m{i}" for i in range(len(patterns))]).alias("found"), F.array(*[
        F.when(F.size(f"m{i}") > 0, F.split(text, p, -1)).otherwise(none) for i, (_, _, p) in enumerate(patterns)]).alias("gaps"))
    gap = lambda i, j: F.get(F.get("gaps", i), j)
    rows = rows.select("doc_id", each("found", lambda s, i, j: F.struct(
        s.alias("s"), F.regexp_replace(s, "[^0-9]", "").alias("d"), F.regexp_replace(s, "[A-Za-z0-9]", "").alias("seps"),
        F.length(gap(i, j)).cast("long").alias("gap"), F.length(s).cast("long").alias("len"),
        F.right(gap(i, j), F.lit(24)).alias("before"), F.left(gap(i, j + 1), F.lit(1)).alias("after"))).alias("found"))
    rows = rows.withColumn("blocks", F.transform("found", lambda own: F.transform(
        F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((F.size(own) - 1) / _BLOCK).cast("int"))),
        lambda b: F.transform(F.slice(own, b * _BLOCK + 1, F.lit(_BLOCK)), lambda x: x["gap"] + x["len"]))))
    rows = rows.withColumn("sums", F.transform("blocks", lambda own: F.transform(own, total)))
    rows = rows.withColumn("sums", F.transform("sums", lambda own: F.transform(
        own, lambda _, k: total(F.slice(own, F.lit(1), k)))))
    rows = rows.withColumn("at", F.transform("blocks", lambda own, i: F.flatten(F.transform(own, lambda block, k: F.transform(
        block, lambda _, j: F.get(F.get("sums", i), k) + total(F.slice(block, F.lit(1), j)))))))
    rows = rows.select("doc_id", each("found", lambda x, i, j: F.struct(
        (F.get(F.get("at", i), j) + x["gap"]).alias("start"), F.length(x["d"]).alias("n"),
        *_fields(x, "len", "s", "d", "seps", "before", "after"))).alias("found"))
    rows = rows.select("doc_id", each("found", lambda x, i, j: F.struct(
        *_fields(x, "start", "len", "d", "n", "seps", "before", "after"), _passes(i, x).alias("passes"))).alias("found"))
    rows = rows.select("doc_id", each("found", lambda x, i, j: F.struct(
        x["start"].alias("start"), (i % 4).alias("kind"), (x["start"] + x["len"]).alias("end"), _cell(i % 4, x).alias("cell"),
        x["passes"].alias("passes"))).alias("found"))
    part = lambda name, at, ps: F.flatten(F.slice("found", at + 1, len(ps))).alias(name)
    return rows.select("doc_id", part("base", 0, BASE), F.filter(part("wide", len(BASE), WIDE), lambda x: x["passes"]).alias("wide"),
                       F.filter(part("near", len(BASE) + len(WIDE), NEAR), lambda x: ~x["passes"]).alias("near"))


def _features(cell: int) -> tuple[int, ...]:
    out = []
    for base in reversed(RADIX):
        out.append(cell % base)
        cell //= base
    return tuple(reversed(out))


def boost(counts: dict[int, tuple[int, int]], rounds: int = ROUNDS):
    """Boosted depth-2 trees over cells with (positive, negative) counts; returns score(cell)."""
    cells = [(_features(c), p, n) for c, (p, n) in sorted(counts.items())]
    pos, neg = sum(c[1] for c in cells), sum(c[2] for c in cells)
    prior = math.log((pos + 1) / (neg + 1))
    tests = sorted({(j, v) for f, _, _ in cells for j, v in enumerate(f)})
    score = [prior] * len(cells)
    trees = []

    def best(rows, g, h):
        whole = (sum(g[i] for i in rows), sum(h[i] for i in rows))
        top = (1e-9, None)
        for j, v in tests:
            a = [i for i in rows if cells[i][0][j] == v]
            if 0 < len(a) < len(rows):
                ga, ha = sum(g[i] for i in a), sum(h[i] for i in a)
                gb, hb = whole[0] - ga, whole[1] - ha
                gain = ga * ga / (ha + 1) + gb * gb / (hb + 1) - whole[0] ** 2 / (whole[1] + 1)
                if gain > top[0] * (1 + 1e-9):  # equal up to rounding: the first test stays
                    top = (gain, (j, v))
        return top[1]

    def leaf(rows, g, h):
        return RATE * sum(g[i] for i in rows) / (sum(h[i] for i in rows) + 1)

    def grow(rows, g, h, depth):
        test = best(rows, g, h) if depth else None
        if test is None:
            return leaf(rows, g, h)
        j, v = test
        return (test, grow([i for i in rows if cells[i][0][j] == v], g, h, depth - 1),
                grow([i for i in rows if cells[i][0][j] != v], g, h, depth - 1))

    def value(tree, f):
        while isinstance(tree, tuple):
            (j, v), yes, no = tree
            tree = yes if f[j] == v else no
        return tree

    for _ in range(rounds if cells else 0):
        p = [1 / (1 + math.exp(-s)) for s in score]
        g = [c[1] * (1 - q) - c[2] * q for c, q in zip(cells, p, strict=True)]
        h = [(c[1] + c[2]) * q * (1 - q) for c, q in zip(cells, p, strict=True)]
        tree = grow(list(range(len(cells))), g, h, 2)
        trees.append(tree)
        score = [s + value(tree, c[0]) for s, c in zip(score, cells, strict=True)]
    return lambda cell: prior + sum(value(t, _features(cell)) for t in trees)


def calibrate(pairs: list[tuple[float, int, int]]):
    """Isotonic calibration of (score, positive, negative) triples; returns probability(score)."""
    steps: list[list[float]] = []
    for s, p, n in sorted(pairs):
        steps.append([s, p, n])
        while len(steps) > 1 and steps[-2][1] / (steps[-2][1] + steps[-2][2]) >= steps[-1][1] / (steps[-1][1] + steps[-1][2]):
            _, p1, n1 = steps.pop()
            steps[-1] = [steps[-1][0], steps[-1][1] + p1, steps[-1][2] + n1]

    def probability(score: float) -> float:
        under = [x for x in steps if x[0] <= score + 1e-9]
        return under[-1][1] / (under[-1][1] + under[-1][2] + 1) if under else 0.0
    return probability


def accepted_cells(found: DataFrame) -> dict[int, float]:
    """Calibrated probability of the wide candidates' cells that are taken (at most CELLS entries)."""
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % HELD_OUT == 0, F.lit(False))
    told = F.concat(F.filter("base", lambda x: x["passes"]), "near")
    rows = found.select(held.alias("held"), F.explode(told).alias("b")).groupBy("held", "b.cell", "b.passes").count()
    counts: dict[bool, dict[int, list[int]]] = {False: {}, True: {}}
    for r in rows.collect():
        counts[r["held"]].setdefault(r["cell"], [0, 0])[0 if r["passes"] else 1] += r["count"]
    wide = [r["cell"] for r in found.select(F.explode("wide").alias("w")).select("w.cell").distinct().collect()]
    out = {}
    for kind in range(len(KINDS)):
        fit, check = ({c: tuple(v) for c, v in counts[h].items() if _features(c)[0] == kind} for h in (False, True))
        seen = [{_features(c)[j] for c, (p, _) in fit.items() if p} for j in CONTEXT]
        score = boost(fit)
        prob = calibrate([(score(c), *v) for c, v in check.items()])
        out |= {c: p for c in wide if _features(c)[0] == kind and (p := prob(score(c))) >= PRECISION
                and all(_features(c)[j] in s for j, s in zip(CONTEXT, seen, strict=True))}
    return out


def _digest(spans: Column) -> Column:
    name = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", F.get(name, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")


def find(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added for every row of docs."""
    ready(docs.sparkSession)
    found = cut(candidates(docs))
    ok = accepted_cells(found)
    base = F.array_sort(F.transform(F.filter("base", lambda x: x["passes"]),
                                    lambda x: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end"))))
    rows = found.select("doc_id", base.alias("base"), "wide")
    meets = lambda x, y: (x["start"] < y["end"]) & (y["start"] < x["end"])
    if ok:
        chance = F.create_map(*[x for c, p in ok.items() for x in (F.lit(c), F.lit(p))])
        good = F.transform(F.filter("wide", lambda x: chance[x["cell"]].isNotNull()), lambda x: F.struct(
            (-chance[x["cell"]]).alias("worse"), x["start"].alias("start"), (-x["end"]).alias("shorter"),
            x["kind"].alias("kind"), x["end"].alias("end")))
        rows = rows.withColumn("good", F.array_distinct(good))
        rows = rows.withColumn("good", F.filter("good", lambda x: ~F.exists("base", lambda y: meets(x, y))))
        added = F.transform(F.filter("good", lambda x: ~F.exists("good", lambda y: meets(x, y) & (y < x))),
                            lambda x: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end")))
    else:
        added = F.slice("base", F.lit(1), F.lit(0))
    rows = rows.withColumn("added", added)
    of = lambda k: F.size(F.filter("base", lambda x: x["kind"] == k)).cast("long")
    count = [of(k).alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return rows.select("doc_id", *count, F.sha2(_digest(F.col("base")), 256).alias("base_sha256"),
                       _digest(F.array_sort(F.concat("base", "added"))).alias("spans"),
                       F.size("added").cast("long").alias("n_added"))
