"""Personal data: patterns, and boosted trees over candidates; DataFrame functions only where texts are handled.

Base spans are the validated matches of one pattern a kind. Besides, high-recall generators propose candidate spans,
which may overlap: loosely written addresses, chains of 7 to 24 digits with any separators, groups of numbers with
colons, dots or dots in brackets, and values of 16 characters and more that may be secrets (a kind that only generators
have). Addresses of over 320 characters are none by their standard, and are not proposed.

Boosted trees score each candidate by its format and its context; per kind, a threshold calibrated on a part of the
sample that the trees haven't seen decides. Selected candidates that overlap no base span are added, the better one
where two overlap.

What the trees learn from is not whether a pattern matches. Examples are base spans and copies of them written in
other ways (a spelt-out at, bracketed dots, a missing plus, other separators), made-up spans of each kind with such copies,
and random values for secrets. Counter
examples are candidates that no reading of their kind allows (_never): numbers that fail a card's check digit, dates
and plain integers for telephones, parts over 255 for addresses, words without a digit for secrets; and made-up dates,
times, versions, ranges and long words. All other candidates are unlabelled, and are what the trees are for. The fit
is on the driver, over SAMPLE candidates (those with the smallest hashes) and their copies; the trees are applied as SQL
expressions. Each document is read once; what is kept of it are its spans and candidates, not its text.

Positions are code points, ends exclusive. Patterns are written with possessive repeats and without a start inside a
run that has failed already, so that long runs of one class take linear time and no stack.

Defined results: a null text counts as empty and has no spans. Identifiers, null or repeated, pass through, a row for
each row. Other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.boosting import Boosted, boost
from tidemark.llm.common import smallest_hashes, written

#: Candidates to learn from, at most, and the share of right ones that a threshold must reach on the calibration part.
SAMPLE = 6000
PRECISION = 0.98
#: Characters of context on each side of a candidate, and of a candidate that can be in the sample.
CONTEXT = 24
SHOWN = 80
#: Trees of the model.
TREES = 30
#: Examples made up of each sort, and the seed for them.
MADE_UP = 150
SEED = 3
#: Matches of one pattern whose positions are summed in one go.
_BLOCK = 256

KINDS = ("email", "ip", "card", "phone")
#: All kinds of spans: those of the patterns and those that only generators propose.
ALL_KINDS = (*KINDS, "secret")

#: One pattern a kind.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}

#: Patterns of the generators.
LOOSE = {
    "email": r"(?:\G|(?<![^\s@<>()\[\]\x22',;]))[^\s@<>()\[\]\x22',;]++[\x20]?(?:@|\(at\)|\[at\])[\x20]?[^\s@<>()\[\]\x22',;]++(?:[\[(](?:\.|dot)[\])][^\s@<>()\[\]\x22',;]++)*+",
    "ip": r"(?:\G|(?<![0-9A-Fa-f:.]))[0-9A-Fa-f]{1,4}+(?:(?:[.:]|\[\.\]|\(\.\))[0-9A-Fa-f]{0,4}+){3,7}+",
    "number": r"[+(]?[0-9](?:[\x20().\/_-]{0,3}+[0-9])++",
    "secret": r"(?:\G|(?<![A-Za-z0-9+\/_=-]))[A-Za-z0-9+\/_=-]{16,}+",
}

#: Words before a span that speak for a kind.
CUES = {
    "email": r"(?i)mail|contact|write|@",
    "ip": r"(?i)\bip\b|addr|host|server",
    "card": r"(?i)card|visa|credit|pay",
    "phone": r"(?i)phone|tel|call|mobile|fax|dial",
    "secret": r"(?i)token|key|secret|passw|pwd|auth|bearer|credential",
}

_FEATURES = ("kind", "length", "digits", "letters", "dots", "seps", "ats", "plus", "paren", "longest", "luhn", "before_word", "after_word", "cue", "context_digits", "context_symbols", "parts", "largest", "upper", "lower", "switches", "assigned")
_NO_MATCH = "array<struct<start:int,end:int,s:string>>"


def found(text: Column, pattern: str) -> Column:
    """Matches of the pattern, leftmost and without overlap: array of (start, end, s).

    A split gives the pieces between the matches, so positions are running sums of lengths. They are summed in blocks,
    so that time is not square in the matches.
    """
    items = F.zip_with(
        F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), 0),
        lambda p, m: F.struct(F.char_length(p).alias("gap"), F.char_length(m).alias("size"), m.alias("s")),
    )
    items = F.filter(items, lambda x: x["s"].isNotNull())  # the last piece has no match after it
    starts = F.sequence(F.lit(0), F.floor((F.greatest(F.size(items), F.lit(1)) - 1) / _BLOCK).cast("int"))

    def local(b: Column) -> Column:
        empty = F.struct(F.lit(0).alias("at"), F.array().cast(_NO_MATCH).alias("out"))

        def add(acc: Column, x: Column) -> Column:
            start = acc["at"] + x["gap"]
            return F.struct((start + x["size"]).alias("at"), F.concat(acc["out"], F.array(F.struct(start.alias("start"), (start + x["size"]).alias("end"), x["s"].alias("s")))).alias("out"))

        return F.aggregate(F.slice(items, b * _BLOCK + 1, F.lit(_BLOCK)), empty, add)

    empty = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{_NO_MATCH}>").alias("out"))

    def join(acc: Column, block: Column) -> Column:
        moved = F.transform(block["out"], lambda x: F.struct((x["start"] + acc["at"]).alias("start"), (x["end"] + acc["at"]).alias("end"), x["s"].alias("s")))
        return F.struct((acc["at"] + block["at"]).alias("at"), F.concat(acc["out"], F.array(moved)).alias("out"))

    return F.flatten(F.aggregate(F.transform(starts, local), empty, join)["out"])


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the digits pass the Luhn check."""
    one = F.filter(F.split(F.reverse(digits), ""), lambda d: F.length(d) > 0)
    value = F.transform(one, lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(value, F.lit(0), lambda a, x: a + x) % 10 == 0


def _valid(kind: str, s: Column) -> Column:
    if kind == "ip":
        parts = F.transform(F.split(s, r"\."), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", ""))
        return F.forall(parts, lambda p: (F.length(p) <= 3) & (F.when(F.length(p) <= 3, p.cast("int")).otherwise(999) <= 255))
    if kind == "card":
        n = F.length(_digits(s))
        return F.when((n >= 12) & (n <= 19), luhn(_digits(s))).otherwise(False)
    if kind == "phone":
        return F.length(_digits(s)).between(9, 15)
    return F.lit(True)


def _spans(kind: str, matches: Column) -> Column:
    k = KINDS.index(kind)
    return F.transform(matches, lambda m: F.struct(m["start"].alias("start"), F.lit(k).alias("kind"), m["end"].alias("end")))


def base_spans(text: Column) -> Column:
    """All base spans of a text, ordered: array of (start, kind as a number, end)."""
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    may = {"email": text.contains("@"), "ip": text.rlike(r"[0-9]\.[0-9]"), "card": text.rlike("[0-9][ -]?[0-9]"), "phone": text.contains("+")}
    valid = lambda kind: F.filter(found(text, BASE[kind]), lambda m: _valid(kind, m["s"]))
    return F.array_sort(F.concat(*(F.when(may[kind], _spans(kind, valid(kind))).otherwise(none) for kind in KINDS)))


def candidates(text: Column) -> Column:
    """Candidate spans of the generators, a number chain once as a card and once as a phone, with what stands around."""
    none = F.array().cast("array<struct<start:int,kind:int,end:int,s:string,before:string,after:string>>")

    def proposed(kind: str, matches: Column) -> Column:
        k = ALL_KINDS.index(kind)
        return F.transform(
            matches,
            lambda m: F.struct(
                m["start"].alias("start"), F.lit(k).alias("kind"), m["end"].alias("end"), m["s"].alias("s"),
                F.substring(text, F.greatest(m["start"] - CONTEXT, F.lit(0)) + 1, F.least(m["start"], F.lit(CONTEXT))).alias("before"),
                F.substring(text, m["end"] + 1, F.lit(CONTEXT)).alias("after"),
            ),
        )

    numbers = F.filter(found(text, LOOSE["number"]), lambda m: F.length(_digits(m["s"])).between(7, 24))
    parts = [
        F.when(text.contains("@") | text.rlike(r"[(\[]at[)\]]"), proposed("email", F.filter(found(text, LOOSE["email"]), lambda m: F.length(m["s"]) <= 320))).otherwise(none),
        F.when(text.rlike(r"[0-9A-Fa-f][\[(]?[.:][\])]?[0-9A-Fa-f]"), proposed("ip", F.filter(found(text, LOOSE["ip"]), lambda m: m["s"].rlike("[0-9]")))).otherwise(none),
        F.when(text.rlike("[0-9]"), F.concat(proposed("card", numbers), proposed("phone", numbers))).otherwise(none),
        F.when(text.rlike(r"[A-Za-z0-9+\/_=-]{16}"), proposed("secret", found(text, LOOSE["secret"]))).otherwise(none),
    ]
    return F.concat(*parts)


def _features(c: Column) -> list[Column]:
    """What the trees see of a candidate, in the order of _FEATURES."""
    s = c["s"]
    count = lambda pattern, x=s: F.length(x) - F.length(F.regexp_replace(x, pattern, ""))
    digits = F.filter(F.split(s, "[^0-9]+"), lambda r: F.length(r) > 0)
    runs = F.transform(digits, lambda r: F.length(r))
    largest = F.array_max(F.transform(digits, lambda r: F.when(F.length(r) <= 9, r.cast("int")).otherwise(10**9)))
    cue = F.lit(0)
    for k, kind in enumerate(ALL_KINDS):
        cue = F.when((c["kind"] == k) & c["before"].rlike(CUES[kind]), 1).otherwise(cue)
    flag = lambda x: F.when(x, 1).otherwise(0)
    return [
        c["kind"], F.length(s), count("[0-9]"), count(r"\p{L}"), count(r"\."), count(r"[\x20()\/_-]"), count("@"), flag(s.startswith("+")), flag(s.contains("(")), F.coalesce(F.array_max(runs), F.lit(0)),
        F.when(count("[0-9]").between(12, 19), flag(luhn(_digits(s)))).otherwise(0), flag(c["before"].rlike(r"[\p{L}\p{N}]$")), flag(c["after"].rlike(r"^[\p{L}\p{N}]")), cue,
        count("[0-9]", F.concat(c["before"], c["after"])), count(r"[^\p{L}\p{N}\s.,]", F.concat(c["before"], c["after"])),
        F.size(digits), F.coalesce(largest, F.lit(-1)), count("[A-Z]"), count("[a-z]"), count("[A-Za-z](?=[0-9])|[0-9](?=[A-Za-z])"), flag(c["before"].rlike(r"[=:]\s?[\x22']?$")),
    ]


def _copies(kind: int, s: str, at: int) -> list[str]:
    """A base span written in other ways; `at` picks among them."""
    digits = re.sub("[^0-9]", "", s)
    if ALL_KINDS[kind] == "email":
        name, _, host = s.partition("@")
        ways = [f"{name} (at) {host}", f"{name}[at]{host}", f"{name} @ {host}", f"{name}@" + host.replace(".", "[.]"), f"{name}(at)" + host.replace(".", "(dot)")]
    elif ALL_KINDS[kind] == "ip":
        ways = [s.replace(".", "[.]"), s.replace(".", "(.)"), s[: s.rindex(".")] + "[.]" + s[s.rindex(".") + 1 :]]
    elif ALL_KINDS[kind] == "card":
        fours = [digits[k : k + 4] for k in range(0, len(digits), 4)]
        ways = [x.join(fours) for x in (".", "/", "_", " - ")]
    else:
        head, area, rest = digits[:-10], digits[-10:-7], digits[-7:]
        ways = [f"({area}) {rest[:3]}-{rest[3:]}", f"{area}-{rest[:3]}-{rest[3:]}", f"{area}.{rest[:3]}.{rest[3:]}", f"{head} {area} {rest[:3]} {rest[3:]}".strip(), f"+{digits[:2]}/{digits[2:]}"]
    return [ways[at % len(ways)], ways[(at + 1) % len(ways)]]


def _never(kind: int, s: str) -> bool:
    """Whether no reading of the kind allows this candidate."""
    digits, parts = re.sub("[^0-9]", "", s), [x for x in re.split("[^0-9]+", s) if x]
    if ALL_KINDS[kind] == "email":
        return not re.search(r"[.\])][A-Za-z]{2,}|dot", re.split(r"@|\(at\)|\[at\]", s)[-1])
    if ALL_KINDS[kind] == "ip":
        return len(parts) < 4 and ":" not in s or ":" not in s and any(len(x) > 3 or int(x) > 255 for x in parts)
    if ALL_KINDS[kind] == "card":
        total = sum(int(d) if i % 2 == 0 else int(d) * 2 - 9 * (int(d) > 4) for i, d in enumerate(reversed(digits)))
        return not 12 <= len(digits) <= 19 or total % 10 != 0
    if ALL_KINDS[kind] == "phone":
        return digits == s or not 9 <= len(digits) <= 15 or re.fullmatch(r"\d{4}[-./]\d\d?[-./]\d\d?.*", s) is not None
    return not re.search("[0-9]", s) or s.isdigit() or len(set(s)) < 6


def examples(sample: list[tuple[int, str, str, str, bool]]) -> list[tuple[int, str, str, str, int]]:
    """Labelled candidates (kind, s, before, after, label) from sampled ones (kind, s, before, after, is a base span)."""
    random, out = np.random.default_rng(SEED), []
    pick = lambda letters, n: "".join(letters[i] for i in random.integers(0, len(letters), n))
    for i, (kind, s, before, after, right) in enumerate(sample):
        if right:
            out.append((kind, s, before, after, 1))
            out += [(kind, copy, before, after, 1) for copy in _copies(kind, s, i)]
        elif _never(kind, s):
            out.append((kind, s, before, after, 0))
    # what a sample may lack: secrets, and what looks like another kind; in contexts from the sample
    contexts = [(before, after) for _, _, before, after, _ in sample[:400]] or [("", "")]
    hexes, base = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    for i in range(MADE_UP):
        before, after = contexts[i % len(contexts)]
        number = lambda low, high: int(random.integers(low, high))
        secret = pick((hexes, hexes.upper(), base, base + "+/")[i % 4], number(20, 65))
        cue = ("token = \"", "api_key: ", "secret=", "password = '", "")[i % 5]
        secret = secret if re.search("[0-9]", secret) else secret[:-1] + "7"
        out.append((4, secret, (before + cue)[-CONTEXT:], after, 1))
        digits = pick("0123456789", 15)
        own = [
            f"{pick(base[26:52], number(1, 9))}{('.', '_', '', str(number(1, 99)))[i % 4]}{pick(base[26:52], number(2, 9))}@{pick(base[26:52], number(2, 10))}.{('com', 'org', 'example.com', 'co.uk')[i % 4]}",
            ".".join(str(number(1, 256)) for _ in range(4)),
            next(digits + d for d in hexes[:10] if not _never(2, digits + d)),
            f"+{number(1, 99)} ({digits[:3]}) {digits[3:6]}-{digits[6:10]}",
        ]
        out += [(k, x, before, after, 1) for k, s in enumerate(own) for x in (s, *_copies(k, s, i))]
        out.append((4, pick(base[26:52], number(16, 40)), before, after, 0))
        out.append((4, "-".join(pick(base[26:52], number(3, 9)) for _ in range(4)), before, after, 0))
        date = f"{number(1900, 2100)}{'-./'[i % 3]}{number(1, 13):02d}{'-./'[i % 3]}{number(1, 29):02d}"
        clock = f"{number(0, 24):02d}:{number(0, 60):02d}:{number(0, 60):02d}:{number(0, 60):02d}"
        span = f"{number(1, 3000)}-{number(3000, 9000)}"
        for s in (date, f"{date} {number(0, 24):02d}", span, str(number(10**6, 10**10)), f"{number(1, 99)}.{number(0, 99)}.{number(256, 9999)}"):
            out += [(k, s, before, after, 0) for k in (2, 3)]
        word = lambda: pick(base[26:52], number(2, 12))
        out += [(0, s, before, after, 0) for s in (f"{word()}@{word()}", f"{word()} @ {word()}", f"{number(1, 99)}@{number(1, 99)}.{number(10, 99)}", f"{word()}(at){word()}", f"{word()} (at) {word()}", f"{number(1, 99)} @ ${number(1, 99)}.{number(10, 99)}")]
        out += [(1, s, before, after, 0) for s in (clock, f"{number(256, 999)}.{number(0, 99)}.{number(0, 9)}.{number(256, 999)}")]
    return out


@dataclass
class Selector:
    """Trees over candidates and, per kind, the log-odds from which one is selected."""

    model: Boosted
    thresholds: list[float]


def fit(x: np.ndarray, y: np.ndarray) -> Selector:
    """Two thirds of the sample train the trees, the rest calibrates: the lowest threshold whose selection is right in PRECISION of the cases."""
    never = float("inf")
    if not len(y):
        return Selector(Boosted(0.0), [never] * len(ALL_KINDS))
    third = np.random.default_rng(SEED).permutation(len(y)) % 3 == 2
    model = boost(x[~third], y[~third], trees=TREES)
    margin, right, kind = model.margin(x[third]), y[third], x[third, 0]
    thresholds = []
    for k in range(len(ALL_KINDS)):
        own = kind == k
        order = np.argsort(-margin[own], kind="stable")
        m, good = margin[own][order], right[own][order]
        precision = np.cumsum(good) / np.arange(1, len(good) + 1)
        last = np.append(m[1:] < m[:-1], True) if len(m) else np.zeros(0, bool)  # equal margins go together
        ok = np.flatnonzero((precision >= PRECISION) & last & (m > 0))
        thresholds.append(float(m[ok[-1]]) if len(ok) else never)
    return Selector(model, thresholds)


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, base (spans of the patterns) and spans (these and the selected candidates), ordered by start and kind."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text")).select("doc_id", base_spans(F.col("text")).alias("base"), candidates(F.col("text")).alias("cands"))
    is_base = lambda c, base: F.array_contains(base, F.struct(c["start"].alias("start"), c["kind"].alias("kind"), c["end"].alias("end")))
    vector = lambda c: F.array(*(f.cast("double") for f in _features(c)))
    featured = F.transform(
        "cands",
        lambda c: F.struct(
            c["start"].alias("start"), c["kind"].alias("kind"), c["end"].alias("end"), vector(c).alias("x"), is_base(c, F.col("base")).alias("right"),
            F.when(F.length(c["s"]) <= SHOWN, F.struct(c["s"].alias("s"), c["before"].alias("before"), c["after"].alias("after"))).alias("shown"),
        ),
    )
    kept = written(rows.select("doc_id", "base", featured.alias("cands")), "pii-candidates")
    shown = kept.select("doc_id", F.explode("cands").alias("c")).filter(F.col("c.shown").isNotNull()).select("c.kind", "c.shown.*", "c.right", F.xxhash64("doc_id", "c.start", "c.kind").alias("h"), "doc_id", F.col("c.start").alias("start"))
    sample = smallest_hashes(shown, "h", ["doc_id", "start", "kind"], SAMPLE).collect()
    made = examples([(r["kind"], r["s"], r["before"], r["after"], r["right"]) for r in sample])
    made = docs.sparkSession.createDataFrame([(i, *row) for i, row in enumerate(made)], "i int, kind int, s string, before string, after string, label int")
    seen = sorted(made.select("i", vector(F.struct("kind", "s", "before", "after")).alias("x"), "label").collect())
    chosen = fit(np.array([r["x"] for r in seen], np.float64).reshape(-1, len(_FEATURES)), np.array([r["label"] for r in seen], np.float64))

    def margin(c: Column) -> Column:
        return chosen.model.column([c["x"][i] for i in range(len(_FEATURES))])

    overlaps = lambda a, b: (a["start"] < b["end"]) & (b["start"] < a["end"])
    scored = F.transform(F.filter("cands", lambda c: ~F.exists("base", lambda b: overlaps(c, b))), lambda c: F.struct((-margin(c)).alias("m"), c["start"].alias("start"), c["kind"].alias("kind"), c["end"].alias("end")))
    limit = F.array(*map(F.lit, chosen.thresholds))
    picked = F.array_sort(F.filter(scored, lambda c: -c["m"] >= limit[c["kind"]]))
    span = "array<struct<start:int,kind:int,end:int>>"
    added = F.aggregate(picked, F.array().cast(span), lambda acc, c: F.when(F.exists(acc, lambda a: overlaps(a, c)), acc).otherwise(F.concat(acc, F.array(F.struct(c["start"].alias("start"), c["kind"].alias("kind"), c["end"].alias("end"))))))
    return kept.withColumn("added", added).select("doc_id", "base", F.array_sort(F.concat("base", "added")).alias("spans"))


def span_text(spans: str) -> Column:
    """kind:start:end of the spans, joined by commas."""
    names = F.array(*map(F.lit, ALL_KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(text: Column, spans: Column) -> Column:
    """The text with its spans (ordered by start) replaced by their kinds in brackets; of overlapping spans the first."""
    names = F.array(*map(F.lit, ALL_KINDS))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        piece = F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit("["), names[s["kind"]], F.lit("]"))
        return F.when(s["start"] >= acc["at"], F.struct(s["end"].alias("at"), piece.alias("out"))).otherwise(acc)

    return F.aggregate(spans, start, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.char_length(text))))
