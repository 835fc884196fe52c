"""Personal data by candidate gradient boosting, in DataFrame functions only.

High-recall generators propose overlapping spans: every blank-free run with an @, every "name (at)
domain", every run of digits and separators, the latter once per kind it could be. Base spans are
the ones that match a kind's pattern and pass its check. Boosted trees learn from all proposals
whether the check of a kind holds, by format and context; thresholds are calibrated per kind on
held-out documents, and proposals in looser notations than the base patterns that reach their
threshold are added.

Rows: one per row of `docs`, with no shuffle of texts or rows. A null text is an empty one. Equal,
repeated or null doc_ids do no harm, as rows are never matched by id. Without any proposal (empty
tables, too) there is no model and only base spans count. Other columns are ignored, or kept whole
by `redact`, which rewrites `text` and, where it is there, `n_chars`.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from dqtable.llm.common import fill, stored, work_folder

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)
#: The base patterns; possessive and anchored where that changes no match, so that time is linear.
PATTERNS = (
    r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    r"[0-9](?:[ -]?[0-9])++",
    r"\+[0-9][ ().0-9-]+[0-9]",
)
#: Generators. Every base match lies within one run of the first or the last.
AT_RUN = r"(?:(?<!\S)|\G)[^\s@]*+@\S*+"
AT_WORD = r"[^\s@()\[\]]{1,64} ?[(\[]at[)\]] ?[^\s@()\[\]]+"
NUMBER_RUN = r"\+?\(?[0-9][0-9 ().,/-]*[0-9]"
#: Notations that the base patterns of a kind leave out.
LOOSE = (
    None,
    r"^[0-9]{1,3}(?:[., ]{1,2}[0-9]{1,3}){3}$",
    r"^(?:[0-9][ ./,-]?){13,19}$",
    r"^(?:\(|00)[0-9 ().,/-]+$",
)
HINTS = r"(?i)(?:mail|tel|fon|phone|call|fax|mobil|card|karte|carte|visa|konto|host|server|addr|ip)\W*$"
FEATURES = ("kind", "digits", "valid", "groups", "left", "right", "hint")
#: Boosting: rounds of trees of depth two, step, and regularisation.
ROUNDS, STEP, RIDGE = 8, 0.5, 1.0
#: One document in FOLDS is held out; added spans need this precision there, on this many cases.
FOLDS, PRECISION, SUPPORT = 5, 0.95, 20
_RUN = 256


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """`then(value)` with `value` computed once."""
    return F.transform(F.array(value), then)[0]


def _sums(lengths: Column) -> Column:
    """Sums of all earlier elements, in runs, so that long arrays do not cost their square."""

    def running(xs, first):
        add = lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x))
        return F.aggregate(xs, F.array(first), add)

    zero = F.lit(0)
    last = F.floor((F.greatest(F.size(lengths), F.lit(1)) - 1) / _RUN).cast("int")
    runs = F.transform(
        F.sequence(zero, last), lambda k: F.slice(lengths, k * _RUN + 1, F.lit(_RUN))
    )

    def join(parts):
        totals = F.transform(parts, lambda x: F.aggregate(x, zero, lambda a, b: a + b))
        heads = F.slice(running(totals, zero), F.lit(1), F.size(parts))
        inner = F.zip_with(parts, heads, running)
        return F.flatten(F.transform(inner, lambda x: F.slice(x, F.lit(1), F.size(x) - 1)))

    return let(runs, join)


def located(text: Column, pattern: str) -> Column:
    """All matches: array of (m, s, e, before, after), code points, end exclusive.

    Matches and the texts between them alternate, so the places are sums of their lengths.
    """
    cut = F.struct(
        F.split(text, pattern, -1).alias("p"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"),
    )

    def places(c):
        lengths = F.zip_with(
            F.slice(c["p"], F.lit(1), F.size(c["m"])),
            c["m"],
            lambda p, m: F.length(p) + F.length(m),
        )

        def spans(start):
            def span(m, i):
                s = start[i] + F.length(c["p"][i])
                return F.struct(
                    m.alias("m"),
                    s.alias("s"),
                    (s + F.length(m)).alias("e"),
                    F.right(c["p"][i], F.lit(24)).alias("before"),
                    F.left(c["p"][i + 1], F.lit(1)).alias("after"),
                )

            return F.transform(c["m"], span)

        return let(_sums(lengths), spans)

    return let(cut, places)


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(m: Column) -> Column:
    def total(rev):
        def add(acc, i):
            v = rev.substr(i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
            return acc + F.when(v > 9, v - 9).otherwise(v)

        return F.aggregate(F.sequence(F.lit(1), F.length(rev)), F.lit(0), add) % 10 == 0

    return let(F.reverse(_digits(m)), total)


def _checked(kind: int, m: Column) -> Column:
    """Whether a match of a base pattern holds."""
    if kind == EMAIL:
        return F.lit(True)
    if kind == IP:
        return m.rlike(r"^(?:0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])(?:\.|$)){4}$")
    count = F.length(_digits(m))
    if kind == PHONE:
        return count.between(10, 15)
    return F.when(count.between(14, 19), _luhn(m)).otherwise(False)


def _base_in(run: Column, kind: int) -> Column:
    """Base spans (s, k, e) of a kind within one generated run."""
    good = F.filter(located(run["m"], PATTERNS[kind]), lambda x: _checked(kind, x["m"]))
    return F.transform(
        good,
        lambda x: F.struct(
            (run["s"] + x["s"]).alias("s"), F.lit(kind).alias("k"), (run["s"] + x["e"]).alias("e")
        ),
    )


def _well_formed(kind: int, m: Column) -> Column:
    if kind == EMAIL:
        return m.rlike(r"[\w-]\.[A-Za-z]{2,24}\W*$")
    if kind == IP:
        four = F.regexp_replace(m, "[^0-9]+", ".")
        return _checked(IP, four)
    if kind == PHONE:
        return F.length(_digits(m)).between(10, 15)
    return F.when(F.length(_digits(m)).between(13, 19), _luhn(m)).otherwise(False)


def _side(c: Column) -> Column:
    """0: nothing or blank, 1: letter or digit, 2: something else."""
    return F.when((c == "") | c.rlike(r"^\s$"), 0).when(c.rlike(r"^[\p{L}\p{N}]$"), 1).otherwise(2)


def _proposal(run: Column, kind: int, base: Column, loose: Column) -> Column:
    groups = F.length(F.regexp_replace(run["m"], "[0-9]+", "x")) - 1
    return F.struct(
        run["s"].alias("s"),
        run["e"].alias("e"),
        F.lit(kind).alias("kind"),
        F.least(F.length(_digits(run["m"])), F.lit(24)).alias("digits"),
        F.coalesce(_well_formed(kind, run["m"]), F.lit(False)).cast("int").alias("valid"),
        F.least(groups, F.lit(12)).alias("groups"),
        _side(F.right(run["before"], F.lit(1))).alias("left"),
        _side(run["after"]).alias("right"),
        run["before"].rlike(HINTS).cast("int").alias("hint"),
        # 1: holds a base span of the kind, 0: holds none, null: not for the base patterns to say
        F.when(F.size(base) > 0, 1).when(~loose, 0).alias("label"),
    )


def _judged(run: Column, kind: int, loose: Column) -> Column:
    """The base spans of a kind within a run, and the run as a proposal."""

    def both(found):
        return F.struct(found.alias("base"), _proposal(run, kind, found, loose).alias("cand"))

    return let(_base_in(run, kind), both)


def _kinds_of(run: Column) -> Column:
    """A run of digits, judged once per kind that it could be."""
    return F.array(*[_judged(run, k, run["m"].rlike(LOOSE[k])) for k in (IP, CARD, PHONE)])


def proposals(docs: DataFrame, carry: list[str]) -> DataFrame:
    """The carried columns of `docs` (which needs `text`), base spans `base`, proposals `cands`."""
    text = F.col("text")
    none = F.array().cast("array<struct<m:string,s:int,e:int,before:string,after:string>>")
    rows = docs.select(*carry, fill().alias("text"))
    rows = rows.withColumn("at_runs", F.when(text.contains("@"), located(text, AT_RUN)).otherwise(none))
    spelled = text.contains("(at)") | text.contains("[at]")
    rows = rows.withColumn("at_words", F.when(spelled, located(text, AT_WORD)).otherwise(none))
    number = F.filter(located(text, NUMBER_RUN), lambda r: F.length(_digits(r["m"])) >= 4)
    rows = rows.withColumn("number_runs", number).drop("text")
    mails = F.transform("at_runs", lambda r: _judged(r, EMAIL, F.lit(False)))
    words = F.transform(
        "at_words", lambda r: _proposal(r, EMAIL, F.array(), F.lit(True))
    )
    rows = rows.select(
        *carry,
        mails.alias("mails"),
        words.alias("words"),
        F.flatten(F.transform("number_runs", _kinds_of)).alias("numbers"),
    )
    both = F.concat("mails", "numbers")
    return rows.select(
        *carry,
        F.flatten(F.transform(both, lambda x: x["base"])).alias("base"),
        F.concat(F.transform(both, lambda x: x["cand"]), F.col("words")).alias("cands"),
    )


Test = tuple[str, int]  # a feature is at most a value


@dataclass
class Model:
    """Trees as (tests at the root, left, right; four leaf values), and a threshold per kind."""

    trees: list[tuple[Test, Test, Test, tuple[float, float, float, float]]] = field(
        default_factory=list
    )
    thresholds: dict[int, float] = field(default_factory=dict)

    def margin(self, get: Callable[[str], Column]) -> Column:
        """The sum of the trees' leaves; `get` gives a feature's column."""

        def holds(test):
            return get(test[0]) <= test[1]

        out = F.lit(0.0)
        for root, left, right, leaf in self.trees:
            low = F.when(holds(left), leaf[0]).otherwise(leaf[1])
            high = F.when(holds(right), leaf[2]).otherwise(leaf[3])
            out = out + F.when(holds(root), low).otherwise(high)
        return out

    def chosen(self, cand: Column) -> Column:
        if not self.trees or not self.thresholds:
            return F.lit(False)
        limit = F.lit(None).cast("double")
        for kind, value in self.thresholds.items():
            limit = F.when(cand["kind"] == kind, value).otherwise(limit)
        return F.coalesce(self.margin(lambda f: cand[f]) >= limit, F.lit(False))


def _best(rows: list[Row]) -> tuple[Test, float, float]:
    """The split with the largest gain among sums of gradients per feature and value."""
    by: dict[str, list[Row]] = {}
    for r in sorted(rows, key=lambda r: (r.f, r.v)):
        by.setdefault(r.f, []).append(r)
    best = None
    for name in FEATURES:
        own = by.get(name, [])
        g, h = sum(r.g for r in own), sum(r.h for r in own)
        gl = hl = 0.0
        for r in own:
            gl, hl = gl + r.g, hl + r.h
            gr, hr = g - gl, h - hl
            gain = round(gl * gl / (hl + RIDGE) + gr * gr / (hr + RIDGE), 6)
            if best is None or gain > best[0]:
                leaf = [round(-STEP * a / (b + RIDGE), 6) for a, b in ((gl, hl), (gr, hr))]
                best = (gain, (name, r.v), *leaf)
    return best[1:] if best else (("kind", len(KINDS)), 0.0, 0.0)


def fit(rows: DataFrame, folder: str) -> Model:
    """Boosted trees and thresholds from a stored table of proposals.

    All labelled proposals are summed into cells of equal features, so a round sees the whole
    corpus at the cost of a table whose size only the features bound. What a round collects is a
    sum per node, feature and value, and never more than a few thousand rows.
    """
    held = (F.pmod(F.xxhash64("key"), F.lit(FOLDS)) == 0).alias("held")
    cands = rows.select(held, F.explode("cands").alias("c")).where("c.label is not null")
    cells = cands.groupBy("held", *[F.col(f"c.{f}").alias(f) for f in FEATURES], "c.label")
    cells = stored(cells.agg(F.count("*").alias("n")), f"{folder}/cells")
    model = Model()
    learn = cells.where("not held")
    if learn.isEmpty():
        return model
    stack = F.explode(F.array(*[F.struct(F.lit(f).alias("f"), F.col(f).alias("v")) for f in FEATURES]))

    def split(node: Column) -> dict[int, list[Row]]:
        p = 1 / (1 + F.exp(-model.margin(F.col)))
        grad = learn.select(
            node.alias("node"),
            (F.col("n") * (p - F.col("label"))).alias("g"),
            (F.col("n") * p * (1 - p)).alias("h"),
            stack.alias("x"),
        )
        sums = grad.groupBy("node", "x.f", "x.v").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))
        out: dict[int, list[Row]] = {0: [], 1: []}
        for r in sums.collect():
            out[r.node].append(r)
        return out

    for _ in range(ROUNDS):
        root = _best(split(F.lit(0))[0])[0]
        sides = split((F.col(root[0]) > root[1]).cast("int"))
        (left, *low), (right, *high) = _best(sides[0]), _best(sides[1])
        model.trees.append((root, left, right, (*low, *high)))
    model.thresholds = _calibrated(cells.where("held"), model)
    return model


def _calibrated(held: DataFrame, model: Model) -> dict[int, float]:
    """Per kind, the lowest margin above which held-out proposals are right often enough."""
    bins = held.select(
        "kind", F.floor(model.margin(F.col) * 8).alias("bin"), "n", (F.col("n") * F.col("label")).alias("y")
    )
    sums = bins.groupBy("kind", "bin").agg(F.sum("n").alias("n"), F.sum("y").alias("y")).collect()
    out = {}
    for kind in range(len(KINDS)):
        n = y = 0
        for r in sorted((r for r in sums if r.kind == kind), key=lambda r: -r.bin):
            n, y = n + r.n, y + r.y
            if r.bin < 0:
                break
            if y >= SUPPORT and y >= PRECISION * n:
                out[kind] = r.bin / 8
    return out


def _all_spans(model: Model) -> Column:
    """Base and added spans (s, k, e), by place and kind; an added span meets no base span."""
    wanted = F.filter("cands", lambda c: c["label"].isNull() & model.chosen(c))
    added = F.transform(
        wanted, lambda c: F.struct(c["s"].alias("s"), c["kind"].alias("k"), c["e"].alias("e"))
    )
    clear = F.filter(
        added, lambda a: ~F.exists("base", lambda b: (b["s"] < a["e"]) & (a["s"] < b["e"]))
    )
    return F.array_sort(F.array_distinct(F.concat("base", clear)))


def _written(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            spans, lambda x: F.concat_ws(":", names[x["k"]], x["s"].cast("string"), x["e"].cast("string"))
        ),
        ",",
    )


def personal_data(docs: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added) per row."""
    folder = work_folder(docs.sparkSession, "pii")
    keyed = docs.select("doc_id", F.col("doc_id").alias("key"), "text")
    rows = stored(proposals(keyed, ["doc_id", "key"]), f"{folder}/proposals")
    model = fit(rows, folder)
    rows = rows.withColumn("spans", _all_spans(model))

    def count(kind):
        return F.size(F.filter("base", lambda b: b["k"] == kind)).cast("long")

    return rows.select(
        "doc_id",
        *[count(k).alias(f"n_{name}") for k, name in enumerate(KINDS)],
        F.sha2(_written(F.array_sort("base")), 256).alias("base_sha256"),
        _written(F.col("spans")).alias("spans"),
        (F.size("spans") - F.size("base")).cast("long").alias("n_added"),
    )


def redact(docs: DataFrame) -> DataFrame:
    """The rows of `docs`, each span of `text` replaced by its kind, as in `[EMAIL]`.

    Spans that overlap an earlier one are cut off with it. The spans are found again beside whole
    rows instead of joining them, so no text is shuffled.
    """
    folder = work_folder(docs.sparkSession, "pii-redact")
    keyed = docs.select(F.xxhash64("text").alias("key"), "text")
    model = fit(stored(proposals(keyed, ["key"]), f"{folder}/proposals"), folder)
    whole = docs.select(F.struct("*").alias("doc"), "text", F.col("text").alias("old"))
    rows = proposals(whole, ["doc", "old"]).withColumn("spans", _all_spans(model))
    marks = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    old = F.col("old")

    def step(acc, x):
        between = old.substr(acc["at"] + 1, x["s"] - acc["at"])
        out = F.when(x["s"] >= acc["at"], F.concat(acc["out"], between, marks[x["k"]]))
        at = F.greatest(acc["at"], x["e"])
        return F.struct(at.alias("at"), out.otherwise(acc["out"]).alias("out"))

    first = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    rest = lambda acc: F.concat(acc["out"], old.substr(acc["at"] + 1, F.length(old)))
    new = F.when(F.size("spans") > 0, F.aggregate("spans", first, step, rest)).otherwise(old)
    rows = rows.select("doc", new.alias("new"), (F.size("spans") > 0).alias("changed"))
    columns = {"text": F.col("new")}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        columns["n_chars"] = F.when(F.col("changed"), F.length("new").cast(kind)).otherwise(
            F.col("doc.n_chars")
        )
    return rows.select(*[columns.get(c, F.col("doc")[c]).alias(c) for c in docs.columns])
