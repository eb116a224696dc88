"""Personal data by candidate gradient boosting, in DataFrame and SQL functions only.

1. Base detectors: one regular expression and validity test per kind; their spans are always kept.
2. High-recall generators propose looser, overlapping candidates (numbers with other separators, split or
   bracketed addresses, phone numbers without a plus sign).
3. Every candidate gets format and context features, all small integers. One grouped count over all
   documents gives the table of distinct feature rows, weighted by how many candidates have a weak label; its
   size is bounded by the features' ranges. Where a base span lies the label is whether it is of the
   candidate's kind. Elsewhere it is whether the candidate's normal form (disguise and separators undone) is
   valid; forms that also occur in plain prose need their kind's keyword. Boosted depth-two trees
   are fitted to that table on half of the documents, and per kind the least score whose precision on the
   other half reaches ``PRECISION``, among all candidates and among those that can be added, becomes the
   threshold (none reaches it: nothing is added).
4. The trees become a column expression; candidates above their threshold that overlap no base span and
   no better candidate are added.

Positions are code points, ends exclusive. Patterns start only where a match can start and use possessive
repeats, so that long runs cost linear time; the matches are those of the plain patterns.

Defined cases: a null text is empty and has no span; rows with null or repeated ids are each judged by
their own text; other columns are ignored; no rows give no rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
# The base patterns, as linear-time equivalents.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++(?: ?(?:@|\(at\)|\[at\]) ?[A-Za-z0-9-]++"
             r"(?:(?:\.| ?\(dot\) ?| ?\[dot\] ?| dot )[A-Za-z0-9-]++)++| at [A-Za-z0-9-]++(?: dot [A-Za-z0-9-]++)++)",
    "ip": r"(?<![0-9.])[0-9]{1,3}(?: ?\[?[.]\]? ?[0-9]{1,3}){3}(?![0-9.])",
    "card": r"(?<![0-9])[0-9](?:[\x20./-]{0,2}[0-9]){12,18}(?![0-9])",
    "phone": r"(?<![0-9A-Za-z])(?:\+|00)?[0-9]{0,3}[\x20.-]?\(?[0-9]{2,4}\)?[\x20./-][0-9]{3,4}[\x20./-]?[0-9]{2,4}(?![0-9A-Za-z])",
}
CONTEXT = {
    "email": r"(?i)(?:e-?mail|contact|write|mail)\W{0,3}$",
    "ip": r"(?i)(?:ip|host|address|server)\W{0,3}$",
    "card": r"(?i)(?:card|visa|credit|payment|pay)\W{0,3}$",
    "phone": r"(?i)(?:phone|tel|call|mobile|fax|cell)\W{0,3}$",
}
FEATURES = ("kind", "digits", "seps", "parts", "valid", "word_before", "word_after", "keyword", "brackets")
TREES = 24
RATE = 0.3
PRECISION = 0.95
SPAN = "struct<k:int,s:int,e:int>"


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often the body uses it."""
    return F.get(F.transform(F.array(value), lambda x: body(x)), F.lit(0))


def _add(a: Column, b: Column) -> Column:
    return a + b


def _blocks(lengths: Column, width: int) -> Column:
    """Sums of consecutive runs of ``width`` entries."""
    return F.transform(
        F.sequence(F.lit(0), F.floor(F.size(lengths) / width).cast("int")),
        lambda b: F.aggregate(F.slice(lengths, b * width + 1, F.lit(width)), F.lit(0), _add))


def _found(text: Column, pattern: str, kind: int, width: int = 64) -> Column:
    """All matches of ``pattern`` as structs (k, s, e, m) with code point positions.

    A position is a running sum of the lengths of matches and of the gaps between them; sums of blocks
    keep it near-linear in the number of matches.
    """

    def spans(hits: Column, steps: Column, blocks: Column) -> Column:
        def span(m: Column, i: Column) -> Column:
            n = i + 1
            whole = F.floor(n / width).cast("int")
            end = F.aggregate(F.slice(blocks, F.lit(1), whole), F.lit(0), _add) + F.aggregate(
                F.slice(steps, whole * width + 1, n % width), F.lit(0), _add)
            return let(end, lambda e: F.struct(
                F.lit(kind).alias("k"), (e - F.length(m)).alias("s"), e.alias("e"), m.alias("m")))

        return F.transform(hits, span)

    def with_gaps(hits: Column, gaps: Column) -> Column:
        steps = F.transform(hits, lambda m, i: F.length(m) + F.length(F.get(gaps, i)))
        return let(steps, lambda st: let(_blocks(st, width), lambda bl: spans(hits, st, bl)))

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
               lambda hits: let(F.split(text, pattern, -1), lambda gaps: with_gaps(hits, gaps)))


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _parts_ok(m: Column) -> Column:
    parts = F.split(F.regexp_replace(m, r"[^0-9.]", ""), r"\.")
    return F.forall(parts, lambda p: (F.length(F.ltrim(p, F.lit("0"))) <= 3) & (F.coalesce(p.try_cast("int"), F.lit(999)) <= 255))


def _valid(kind: str, m: Column) -> Column:
    if kind == "ip":
        return _parts_ok(m)
    if kind == "card":
        d = _digits(m)
        return F.length(d).between(13, 19) & F.call_function("luhn_check", d)
    if kind == "phone":
        return F.length(_digits(m)).between(9, 15)
    return F.lit(True)


def _needs(text: Column, kind: str, loose: bool) -> Column:
    """A cheap test that every text with a match passes."""
    if kind == "email":
        test = text.contains("@")
        if loose:
            test = test | text.contains("(at)") | text.contains("[at]") | (text.contains(" at ") & text.contains(" dot "))
        return test
    if kind == "phone" and not loose:
        return text.contains("+")
    return text.rlike("[0-9]")


def _empty(kind: str) -> Column:
    return F.from_json(F.lit("[]"), kind)


def _passing(spans: Column, kind: str) -> Column:
    return F.filter(spans, lambda c: _valid(kind, c["m"]))


def _all(text: Column, kinds: dict[str, str], loose: bool) -> Column:
    found = []
    for kind, pattern in kinds.items():
        spans = _found(text, pattern, KINDS.index(kind))
        if not loose:
            spans = _passing(spans, kind)
        none = _empty("array<struct<k:int,s:int,e:int,m:string>>")
        found.append(F.when(_needs(text, kind, loose), spans).otherwise(none))
    return F.concat(*found)


def _overlap(a: Column, b: Column) -> Column:
    return (a["s"] < b["e"]) & (b["s"] < a["e"])


def _features(text: Column, c: Column) -> list[Column]:
    before = F.substring(text, F.greatest(c["s"] - 15, F.lit(1)), F.least(c["s"], F.lit(16)))
    after = F.substring(text, c["e"] + 1, F.lit(1))
    d = _digits(c["m"])
    valid, keyword = F.lit(0), F.lit(0)
    for i, kind in enumerate(KINDS):
        valid = F.when(c["k"] == i, _valid(kind, c["m"]).cast("int")).otherwise(valid)
        keyword = F.when(c["k"] == i, before.rlike(CONTEXT[kind]).cast("int")).otherwise(keyword)
    return [
        c["k"],
        F.least(F.length(d), F.lit(20)),
        F.least(F.length(F.regexp_replace(c["m"], r"[^\x20./-]", "")), F.lit(6)),
        F.least(F.size(F.split(c["m"], "[^0-9A-Za-z]+")), F.lit(8)),
        valid,
        before.rlike(r"[\p{L}\p{N}]$").cast("int"),
        after.rlike(r"^[\p{L}\p{N}]").cast("int"),
        keyword,
        c["m"].rlike(r"[()\[\]]").cast("int"),
    ]


def _normal(kind: str, m: Column, keyword: Column) -> Column:
    """Whether ``m``, its disguise undone, is of the kind's own pattern and valid; an open form also needs the kind's keyword before it."""
    if kind == "email":
        plain = F.regexp_replace(F.regexp_replace(m, r" ?(?:@|\(at\)|\[at\]) ?| at ", "@"), r" ?(?:\(dot\)|\[dot\]) ?| dot ", ".")
        return plain.rlike(r"^[A-Za-z0-9._%+-]++@(?:[A-Za-z0-9-]++\.)+[A-Za-z]{2,}$") & (m.rlike(r"@|\(at\)|\[at\]") | keyword)
    if kind == "ip":
        return _valid(kind, m) & (m.contains("[") | ~m.contains(" ") | keyword)
    if kind == "phone":
        return _valid(kind, m) & (m.rlike(r"^(?:\+|00)[1-9]") | keyword)
    return _valid(kind, m)


def _candidates(text: Column, base: Column, loose: Column) -> Column:
    """Loose candidates with weak label, whether a base span takes their place, and features.

    A candidate in a base span's place is labelled by that span's kind, any other by its normal form.
    """

    def one(c: Column) -> Column:
        taken = F.exists(base, lambda b: _overlap(b, c))
        features = F.array(*[f.cast("int") for f in _features(text, c)])

        def made(t: Column, f: Column) -> Column:
            normal = F.lit(False)
            for i, kind in enumerate(KINDS):
                normal = F.when(c["k"] == i, _normal(kind, c["m"], f[FEATURES.index("keyword")] == 1)).otherwise(normal)
            same = F.exists(base, lambda b: (b["k"] == c["k"]) & _overlap(b, c))
            return F.struct(c["k"].alias("k"), c["s"].alias("s"), c["e"].alias("e"),
                            F.when(t, same).otherwise(normal).alias("label"), t.alias("taken"), f.alias("f"))

        return let(taken, lambda t: let(features, lambda f: made(t, f)))

    return F.transform(loose, one)


def _parsed(text: Column) -> Column:
    """Struct of the base spans (k, s, e, m) and the candidates of a text that is not null."""
    return let(_all(text, BASE, False), lambda base: let(
        _all(text, LOOSE, True), lambda loose: F.struct(
            base.alias("base"), _candidates(text, base, loose).alias("cand"))))


@dataclass
class Model:
    """Trees as (feature, cut, (feature, cut, low, high), (feature, cut, low, high)); a threshold per kind."""

    base: float = 0.0
    trees: list = field(default_factory=list)
    threshold: dict = field(default_factory=dict)  # kind index -> least log-odds that is added

    def margin(self, row) -> float:
        total = self.base
        for f, cut, low, high in self.trees:
            g, c, a, b = low if row[f] < cut else high
            total += a if row[g] < c else b
        return total

    def column(self, f: Column) -> Column:
        total = F.lit(self.base)
        for k, cut, low, high in self.trees:
            side = [F.when(f[g] < c, F.lit(a)).otherwise(F.lit(b)) for g, c, a, b in (low, high)]
            total = total + F.when(f[k] < cut, side[0]).otherwise(side[1])
        return total


def _cut(rows: list, slopes: list) -> tuple:
    """(gain, feature, cut, low value, high value) of the best split."""
    g, h = sum(s[0] for s in slopes), sum(s[1] for s in slopes)
    best = (0.0, 0, 0, g / (h + 1), g / (h + 1))
    for f in range(len(FEATURES)):
        by: dict = {}
        for r, (gi, hi) in zip(rows, slopes):
            a = by.setdefault(r[f], [0.0, 0.0])
            a[0] += gi
            a[1] += hi
        gl = hl = 0.0
        values = sorted(by)
        for v, w in zip(values[:-1], values[1:]):
            gl, hl = gl + by[v][0], hl + by[v][1]
            gain = gl**2 / (hl + 1) + (g - gl) ** 2 / (h - hl + 1) - g**2 / (h + 1)
            if gain > best[0] + 1e-9:
                best = (gain, f, w, gl / (hl + 1), (g - gl) / (h - hl + 1))
    return best


def fit(table: list) -> Model:
    """``table``: (feature row, fit positives, fit negatives, other positives, other negatives), of the last two those that can be added."""
    rows = [t[0] for t in table]
    pos, neg = sum(t[1] for t in table), sum(t[2] for t in table)
    if not pos or not neg:
        return Model()
    model = Model(base=math.log(pos / neg))
    margin = [model.base] * len(rows)
    for _ in range(TREES):
        slopes = []
        for t, m in zip(table, margin):
            p = 1 / (1 + math.exp(-max(-30.0, min(30.0, m))))
            slopes.append((t[1] * (1 - p) - t[2] * p, (t[1] + t[2]) * p * (1 - p)))
        _, f, cut, _, _ = _cut(rows, slopes)
        sides = []
        for low in (True, False):
            at = [i for i, r in enumerate(rows) if (r[f] < cut) == low]
            _, g, c, a, b = _cut([rows[i] for i in at], [slopes[i] for i in at])
            sides.append((g, c, RATE * max(-4.0, min(4.0, a)), RATE * max(-4.0, min(4.0, b))))
        model.trees.append((f, cut, *sides))
        margin = [m + (lambda s: s[2] if r[s[0]] < s[1] else s[3])(sides[0] if r[f] < cut else sides[1])
                  for m, r in zip(margin, rows)]
    for k in range(len(KINDS)):
        tp = fp = added = wrong = 0
        best = None
        for m, t in sorted(((m, t) for m, t in zip(margin, table) if t[0][0] == k), key=lambda x: -x[0]):
            tp, fp, added, wrong = tp + t[3], fp + t[4], added + t[5], wrong + t[6]
            if tp and tp / (tp + fp) >= PRECISION and added >= PRECISION * (added + wrong):
                best = m
        if best is not None:
            model.threshold[k] = best - 1e-9
    return model


def train(docs: DataFrame, text_col: str = "text") -> Model:
    """Trees and thresholds from one count over all candidates of all documents."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    counted = docs.select(
        (F.pmod(F.xxhash64(text), F.lit(2)) == 0).alias("fold"),
        F.explode_outer(let(text, lambda t: _parsed(t)["cand"])).alias("c"),
    ).where("c is not null").groupBy("fold", "c.label", "c.taken", F.col("c.f").alias("f")).agg(F.count("*").alias("n"))
    table: dict = {}
    for r in counted.collect():  # bounded: products of the features' ranges
        row = table.setdefault(tuple(r.f), [0] * 6)
        row[(0 if r.fold else 2) + (0 if r.label else 1)] += r.n
        if not r.fold and not r.taken and r.f[FEATURES.index("valid")]:
            row[4 if r.label else 5] += r.n
    return fit([(f, *n) for f, n in sorted(table.items())])


def _plain(spans: Column) -> Column:
    return F.transform(spans, lambda c: F.struct(c["k"].alias("k"), c["s"].alias("s"), c["e"].alias("e")))


def _chosen(cand: Column, model: Model) -> Column:
    """The candidates above their kind's threshold that no base span and no better candidate overlaps."""

    def enough(c: Column) -> Column:
        def above(p: Column) -> Column:
            test = F.lit(False)
            for k, least in sorted(model.threshold.items()):
                test = test | ((c["k"] == k) & (p >= least))
            return test

        return ~c["taken"] & (c["f"][FEATURES.index("valid")] == 1) & let(model.column(c["f"]), above)

    def better(o: Column, c: Column) -> Column:
        return (o["k"] != c["k"]) & _overlap(o, c) & ((o["p"] > c["p"]) | ((o["p"] == c["p"]) & (o["k"] < c["k"])))

    good = F.transform(F.filter(cand, enough), lambda c: F.struct(
        model.column(c["f"]).alias("p"), c["k"].alias("k"), c["s"].alias("s"), c["e"].alias("e")))
    return let(good, lambda g: F.filter(g, lambda c: ~F.exists(g, lambda o: better(o, c))))


def spans(text: Column, model: Model) -> Column:
    """Struct (base, spans) of arrays of (k, s, e), sorted by kind, then start; a null text has none."""

    def both(parsed: Column) -> Column:
        base = _plain(parsed["base"])
        every = F.concat(base, _plain(_chosen(parsed["cand"], model))) if model.threshold else base
        return F.struct(F.sort_array(base).alias("base"), F.sort_array(every).alias("spans"))

    return let(F.coalesce(text.cast("string"), F.lit("")), lambda t: let(_parsed(t), both))


def joined(spans: Column) -> Column:
    """kind:start:end of every span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda c: F.concat_ws(
        ":", F.get(names, c["k"]), c["s"].cast("string"), c["e"].cast("string"))), ",")


def redacted(text: Column, model: Model) -> Column:
    """``text`` with every span replaced by its kind in brackets; overlapping spans become one."""
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])

    def rebuilt(order: Column, ends: Column) -> Column:
        def piece(c: Column, i: Column) -> Column:
            done = F.when(i > 0, F.array_max(F.slice(ends, F.lit(1), i))).otherwise(F.lit(0))
            return let(done, lambda d: F.when(c["s"] >= d, F.concat(
                text.substr(d + 1, c["s"] - d), F.get(names, c["k"]))).otherwise(F.lit("")))

        rest = F.array_max(ends)
        return F.concat(F.array_join(F.transform(order, piece), ""), text.substr(rest + 1, F.length(text)))

    def replaced(found: Column) -> Column:
        order = F.sort_array(F.transform(found["spans"], lambda c: F.struct(
            c["s"].alias("s"), c["e"].alias("e"), c["k"].alias("k"))))
        return let(order, lambda o: F.when(F.size(o) == 0, text).otherwise(
            let(F.transform(o, lambda c: c["e"]), lambda e: rebuilt(o, e))))

    return let(spans(text, model), replaced)
