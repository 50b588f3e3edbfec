"""Personal data spans by weak supervision, in DataFrame expressions only.

Base spans follow fixed patterns (email, ip, card, phone) and always stand.
Looser candidates (spelled-out mail addresses, national phone numbers, social
security numbers, IBANs) are judged: five labelers (strict pattern, gazetteer,
context words, surroundings, variety of characters) vote yes, no or nothing on
every candidate, base ones too. Votes are counted by pattern, a table whose
size the votes bound (``PATTERNS`` rows at most); expectation-maximisation over
it estimates each labeler's reliability, and the posteriors train a logistic
span classifier. Its weights become literals of one Column expression.

Patterns are possessive and look behind once, so they take time linear in the
text. Offsets count code points, ends are exclusive.

Defined results: null and empty texts have no spans; repeated rows are judged
alike; extra columns are ignored by ``find_spans`` and kept by ``mask``;
without candidates nothing is added; an empty table gives no rows. Span ties
are ordered by start, then kind (email, ip, card, phone, ssn, iban), then end.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from radspark.llm.common import spool

# Kinds in their order, and the patterns of base spans.
KINDS = ("email", "ip", "card", "phone", "ssn", "iban")
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[ -]?[0-9]){11,}+"  # shorter runs would be dropped
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
# Patterns of looser candidates.
SPELLED = (r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+ ?[\[({] ?(?:at|AT) ?[\])}] ?[A-Za-z0-9-]{1,63}+"
           r"(?: ?[\[({] ?(?:dot|DOT) ?[\])}] ?[A-Za-z0-9-]{1,63}+|\.[A-Za-z0-9-]{1,63}+)++")
NATIONAL = r"(?<![0-9A-Za-z.+-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z-])"
SSN = r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
# Gazetteers and context words.
ENDINGS = ("com", "org", "net", "edu", "gov", "info", "io", "de", "fr", "es", "uk", "eu", "us", "ca", "ch", "at", "it")
BANKS = ("DE", "FR", "ES", "GB", "IT", "NL", "BE", "AT", "CH", "PT", "IE", "LU", "PL", "SE", "DK", "NO", "FI")
FOR = ("mail|contact|write|reply|phone|tel|call|fax|mobile|sms|whatsapp|card|visa|credit|account|iban|bank|ssn|social|"
       "security|address|host|server|client|login|user|correo|courriel|telefon|llame|appel|konto|karte")
AGAINST = "version|release|section|chapter|figure|table|isbn|issn|invoice|order|build|page|part|model|serial|article"

LABELERS = ("strict", "gazetteer", "context", "surroundings", "variety")
#: Vote patterns there can be: kinds, three votes of each labeler, three lengths.
PATTERNS = len(KINDS) * 2 * 3 ** len(LABELERS) * 3

SPAN = "array<struct<start:bigint,rank:int,end:bigint,kind:string,value:string,before:string,after:string>>"


#: Rows that are folded in one run: lists and strings grow by runs, so a text with very many matches costs little more for each.
RUN = 1024


def _fold(rows: Column, out: Column, step, join) -> Column:
    """``F.aggregate`` over structs {at, out} from {0, ``out``}, a run of rows at a time; ``join`` puts the runs' outs together."""
    def each(r: Column) -> Column:
        runs = F.transform(F.sequence(F.lit(0), F.greatest(F.floor((F.size(r) - 1) / RUN), F.lit(0)).cast("int")), lambda k: F.slice(r, k * RUN + 1, F.lit(RUN)))
        kind = F.array(out)  # one out; empty below

        def run(acc: Column, part: Column) -> Column:
            inner = F.aggregate(part, F.struct(acc["at"].alias("at"), out.alias("out")), step)
            return F.transform(F.array(inner), lambda i: F.struct(i["at"].alias("at"), F.concat(acc["outs"], F.array(i["out"])).alias("outs")))[0]

        return F.aggregate(runs, F.struct(F.lit(0).cast("bigint").alias("at"), F.slice(kind, 1, F.lit(0)).alias("outs")), run, join)

    return F.transform(F.array(rows), each)[0]  # bound once


def _found(text: Column, pattern: str, kind: str) -> Column:
    """All matches of a pattern, with offsets and up to 40 characters around.

    What stands between matches comes from splitting; offsets are running sums
    of lengths. The one-element array binds both lists, so each is made once.
    """
    lists = F.array(F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"), F.split(text, pattern, -1).alias("g")))

    def fold(s: Column) -> Column:
        rows = F.zip_with(s["m"], F.slice(s["g"], F.lit(1), F.size(s["m"])), lambda m, g: F.struct(m.alias("m"), g.alias("g")))
        rows = F.zip_with(rows, F.slice(s["g"], F.lit(2), F.size(s["m"])), lambda r, n: F.struct(r["m"].alias("m"), r["g"].alias("g"), n.alias("n")))

        def step(acc: Column, r: Column) -> Column:
            start = acc["at"] + F.char_length(r["g"])
            end = start + F.char_length(r["m"])
            span = F.struct(start.cast("bigint").alias("start"), F.lit(KINDS.index(kind)).alias("rank"), end.cast("bigint").alias("end"),
                            F.lit(kind).alias("kind"), r["m"].alias("value"), F.right(r["g"], F.lit(40)).alias("before"),
                            F.left(r["n"], F.lit(40)).alias("after"))
            return F.struct(end.cast("bigint").alias("at"), F.concat(acc["out"], F.array(span)).alias("out"))

        return _fold(rows, F.array().cast(SPAN), step, lambda acc: F.flatten(acc["outs"]))

    return F.transform(lists, fold)[0]


def _digits(v: Column) -> Column:
    return F.regexp_replace(v, "[^0-9]", "")


def _luhn(v: Column) -> Column:
    """Whether digits pass: every second one from the right doubled, cross sums added."""
    back = F.transform(F.split(F.reverse(_digits(v)), ""), lambda d: F.coalesce(d.try_cast("int"), F.lit(0)))
    worth = F.transform(back, lambda d, i: F.when(i % 2 == 0, d).otherwise(F.when(d > 4, d * 2 - 9).otherwise(d * 2)))
    return F.aggregate(worth, F.lit(0), lambda a, d: a + d) % 10 == 0


def _octets(v: Column) -> Column:
    return F.forall(F.split(v, r"\."), lambda p: F.coalesce(F.regexp_replace(p, "^0+(?=[0-9])", "").try_cast("int"), F.lit(999)) <= 255)


def base_spans(text: Column) -> Column:
    """The spans that the fixed patterns and checks give, ordered."""
    none = F.array().cast(SPAN)
    size = lambda x: F.length(_digits(x["value"]))
    email = F.when(text.contains("@"), _found(text, EMAIL, "email")).otherwise(none)
    ip = F.when(text.rlike(r"[0-9]\.[0-9]"), F.filter(_found(text, IP, "ip"), lambda x: _octets(x["value"]))).otherwise(none)
    card = F.when(text.rlike(r"[0-9](?:[ -]?[0-9]){11}"), F.filter(_found(text, CARD, "card"), lambda x: size(x).between(12, 19) & _luhn(x["value"]))).otherwise(none)
    phone = F.when(text.contains("+"), F.filter(_found(text, PHONE, "phone"), lambda x: size(x).between(9, 15))).otherwise(none)
    return F.sort_array(F.concat(email, ip, card, phone))


def loose_spans(text: Column) -> Column:
    none = F.array().cast(SPAN)
    return F.sort_array(F.concat(
        F.when(text.rlike(r"[\[({] ?(?:at|AT) ?[\])}]"), _found(text, SPELLED, "email")).otherwise(none),
        F.when(text.rlike(r"[0-9]{3}[ .-][0-9]{4}"), _found(text, NATIONAL, "phone")).otherwise(none),
        F.when(text.rlike(r"[0-9]{3}-[0-9]{2}-[0-9]{4}"), _found(text, SSN, "ssn")).otherwise(none),
        F.when(text.rlike(r"[A-Z]{2}[0-9]{2} ?[A-Z0-9]{4}"), _found(text, IBAN, "iban")).otherwise(none)))


def _vote(yes: Column, no: Column) -> Column:
    return F.when(no, F.lit(-1)).when(yes, F.lit(1)).otherwise(F.lit(0))


def _votes(x: Column) -> dict[str, Column]:
    kind, v = x["kind"], x["value"]
    digits = _digits(v)
    ending = F.lower(F.regexp_extract(v, r"([A-Za-z0-9-]+)[\])} ]*$", 1))
    mail, ip, card, phone, ssn, iban = (kind == k for k in KINDS)
    strict = _vote(
        (mail & v.rlike(r"^[A-Za-z0-9][A-Za-z0-9._+-]*@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$")) | (ip & v.rlike(r"^[1-9][0-9]{0,2}(\.[0-9]{1,3}){3}$"))
        | (card & v.rlike(r"^([0-9]{12,19}|[0-9]{4}([ -][0-9]{4}){3})$")) | (phone & v.rlike(r"^\+?[0-9 ]*(\([0-9]{3}\))? ?[0-9]{3}[ .-][0-9]{4}$"))
        | (ssn & v.rlike(r"^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}$")) | (iban & F.length(F.replace(v, F.lit(" "), F.lit(""))).between(15, 34)),
        (mail & v.rlike(r"^[0-9.%+-]+@")) | (ssn & v.rlike("^(000|666|9)")) | (phone & digits.rlike("^0{4}")))
    gazetteer = _vote(
        (mail & ending.isin(*ENDINGS)) | (card & digits.rlike("^[3-6]")) | (iban & F.left(v, F.lit(2)).isin(*BANKS)) | (phone & digits.rlike("^1?[2-9][0-9]{2}[2-9]")),
        (ip & v.rlike(r"^(0|127|255)\.")) | (mail & ending.rlike("^[0-9]+$")) | (iban & ~F.left(v, F.lit(2)).isin(*BANKS)))
    around = F.lower(F.concat(x["before"], F.lit(" "), F.left(x["after"], F.lit(20))))
    context = _vote(around.rlike(f"(?:^|[^a-z])(?:{FOR})"), around.rlike(f"(?:^|[^a-z])(?:{AGAINST})"))
    left, right = F.right(x["before"], F.lit(1)), F.left(x["after"], F.lit(1))
    surroundings = _vote(left.rlike(r"^[\s(\[{<>\"',:;=]?$") & right.rlike(r"^[\s)\]}<>\"',.;:!?]?$"), left.rlike(r"[\p{L}0-9_/=]$") | right.rlike(r"^[\p{L}0-9_/=]"))
    kinds_of_digit = F.size(F.array_distinct(F.split(digits, "")))
    variety = _vote(mail | (kinds_of_digit >= 5), ~mail & (kinds_of_digit <= 2))
    return dict(zip(LABELERS, (strict, gazetteer, context, surroundings, variety)))


JUDGED = ("array<struct<start:bigint,rank:int,end:bigint,kind:string,base:boolean,span:int,"
          + ",".join(f"{n}:int" for n in LABELERS) + ">>")


def _judged(spans: Column, base: bool) -> Column:
    def one(x: Column) -> Column:
        n = F.char_length(x["value"])
        span = F.when(n < 14, 0).when(n < 20, 1).otherwise(2)
        return F.struct(x["start"].alias("start"), x["rank"].alias("rank"), x["end"].alias("end"), x["kind"].alias("kind"), F.lit(base).alias("base"),
                        span.alias("span"), *[v.alias(k) for k, v in _votes(x).items()])

    return F.transform(spans, one).cast(JUDGED)


def _apart(base: Column, loose: Column) -> Column:
    """Loose spans that overlap no base span, in order of their ends.

    One walk over base spans by start and loose ones by end: when a loose span
    comes, every base span that starts before its end has passed, and the
    furthest end of those tells whether one reaches into it.
    """
    row = lambda at, own: lambda x: F.struct(x[at].alias("at"), F.lit(own).alias("own"), x.alias("x"))
    rows = F.sort_array(F.concat(F.transform(loose, row("end", 0)), F.transform(base, row("start", 1))))  # ties: the loose one first

    def step(acc: Column, r: Column) -> Column:
        keep = (r["own"] == 0) & (acc["at"] <= r["x"]["start"])
        return F.struct(F.when(r["own"] == 1, F.greatest(acc["at"], r["x"]["end"])).otherwise(acc["at"]).alias("at"),
                        F.when(keep, F.concat(acc["out"], F.array(r["x"]).cast(SPAN))).otherwise(acc["out"]).alias("out"))

    none = F.array().cast(SPAN)
    return F.when((F.size(base) == 0) | (F.size(loose) == 0), loose).otherwise(_fold(rows, none, step, lambda acc: F.flatten(acc["outs"])))


def candidates(text: Column) -> Column:
    """All candidates of a text with their votes; loose ones that overlap a base span are left out."""
    both = F.array(F.struct(base_spans(text).alias("b"), loose_spans(text).alias("l")))

    def join(s: Column) -> Column:
        return F.concat(_judged(s["b"], True), _judged(_apart(s["b"], s["l"]), False))

    return F.transform(both, join)[0]


@dataclass
class Judge:
    """Weights of the span classifier: of kinds, of each labeler's votes, of lengths."""

    kinds: dict[str, float]
    votes: dict[str, tuple[float, float, float]]
    spans: tuple[float, float, float]
    reliability: dict[str, float]

    def logit(self, x: Column) -> Column:
        def pick(value: Column, weights: dict) -> Column:
            out = F.lit(0.0)
            for k, w in weights.items():
                out = F.when(value == k, F.lit(float(w))).otherwise(out)
            return out

        total = pick(x["kind"], self.kinds) + pick(x["span"], dict(enumerate(self.spans)))
        for n, w in self.votes.items():
            total = total + pick(x[n], dict(zip((-1, 0, 1), w)))
        return total


def learn(spans: DataFrame) -> Judge:
    """Reliabilities and classifier from a table with a column ``spans`` of candidates."""
    rows = (spans.select(F.explode("spans").alias("x")).select("x.kind", "x.span", "x.base", *[f"x.{n}" for n in LABELERS])
            .groupBy("kind", "span", "base", *LABELERS).agg(F.count(F.lit(1)).alias("n")).orderBy("kind", "span", "base", *LABELERS)
            .limit(PATTERNS).collect())  # PATTERNS is the number of all possible rows
    none = Judge({}, {}, (0.0, 0.0, 0.0), {})
    if not rows:
        return none
    n = np.array([r["n"] for r in rows], float)
    kind = np.array([KINDS.index(r["kind"]) * 2 + r["base"] for r in rows])
    votes = np.array([[r[k] + 1 for k in LABELERS] for r in rows])
    prior = np.where(np.arange(2 * len(KINDS)) % 2, 0.9, 0.5)
    given = np.tile(np.array([[0.5, 0.3, 0.2], [0.1, 0.3, 0.6]]), (len(LABELERS), 1, 1))  # labeler, truth, vote
    post = np.full(len(rows), 0.5)
    for _ in range(60):
        like = [np.prod([given[k, y, votes[:, k]] for k in range(len(LABELERS))], axis=0) for y in (0, 1)]
        p1, p0 = prior[kind] * like[1], (1 - prior[kind]) * like[0]
        post = p1 / (p1 + p0)
        for k in range(len(LABELERS)):
            for y, w in ((0, n * (1 - post)), (1, n * post)):
                c = np.bincount(votes[:, k], w, 3) + (np.array([5.0, 3.0, 1.0]) if y == 0 else np.array([1.0, 3.0, 5.0]))
                given[k, y] = c / c.sum()
        total = np.bincount(kind, n, 2 * len(KINDS))
        strength = np.where(np.arange(2 * len(KINDS)) % 2, 0.9, 0.5) * 20
        prior = (np.bincount(kind, n * post, 2 * len(KINDS)) + strength) / (total + 20)
    # a classifier that no longer sees which candidates are base spans
    x = np.zeros((len(rows), len(KINDS) + 3 * len(LABELERS) + 3))
    at = np.arange(len(rows))
    x[at, kind // 2] = 1
    for k in range(len(LABELERS)):
        x[at, len(KINDS) + 3 * k + votes[:, k]] = 1
    x[at, len(KINDS) + 3 * len(LABELERS) + np.array([r["span"] for r in rows])] = 1
    w, weight = np.zeros(x.shape[1]), n / n.sum() * min(n.sum(), 1e4)
    for _ in range(30):
        p = 1 / (1 + np.exp(-x @ w))
        grad = x.T @ (weight * (post - p)) - w
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + np.eye(len(w))
        w = w + np.linalg.solve(hess, grad)
    own = w[len(KINDS):].reshape(-1, 3)
    right = {name: float((given[k, 1, 2] + given[k, 0, 0]) / (given[k, 1, [0, 2]].sum() + given[k, 0, [0, 2]].sum())) for k, name in enumerate(LABELERS)}
    return Judge(dict(zip(KINDS, w.tolist())), {name: tuple(own[k].tolist()) for k, name in enumerate(LABELERS)}, tuple(own[-1].tolist()), right)


def accepted(spans: Column, judge: Judge) -> Column:
    """Base spans, and the others that the classifier takes for personal data, ordered."""
    return F.sort_array(F.filter(spans, lambda x: x["base"] | (judge.logit(x) > 0)))


def _written(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def find_spans(docs: DataFrame) -> DataFrame:
    """doc_id, counts of base spans by kind, base_sha256 and spans of every row."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    found = spool(docs.select(F.col("doc_id").cast("long").alias("doc_id"), candidates(text).alias("spans")))
    judge = learn(found)
    base = F.filter("spans", lambda x: x["base"])
    tally = lambda k: F.size(F.filter("spans", lambda x: x["base"] & (x["kind"] == k))).cast("long")
    counts = [tally(k).alias(f"n_{k}") for k in KINDS[:4]]
    return found.select("doc_id", *counts, F.sha2(_written(F.sort_array(base)), 256).alias("base_sha256"), _written(accepted(F.col("spans"), judge)).alias("spans"))


def mask(docs: DataFrame) -> DataFrame:
    """``docs`` with every accepted span of ``text`` replaced by its kind in angle brackets."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    judge = learn(docs.select(candidates(text).alias("spans")))

    def step(acc: Column, x: Column) -> Column:
        piece = F.substr(F.col("text"), (acc["at"] + 1).cast("int"), F.greatest(x["start"] - acc["at"], F.lit(0)).cast("int"))
        inside = x["start"] < acc["at"]
        return F.struct(F.greatest(acc["at"], x["end"]).alias("at"),
                        F.concat(acc["out"], F.when(inside, F.lit("")).otherwise(F.concat(piece, F.lit("<"), F.upper(x["kind"]), F.lit(">")))).alias("out"))

    spans = accepted(candidates(text), judge)
    done = _fold(spans, F.lit(""), step, lambda acc: F.concat(F.array_join(acc["outs"], ""), F.substr(F.col("text"), (acc["at"] + 1).cast("int"))))
    # only rows with a candidate sign are rebuilt; the others keep their text as it is
    return docs.withColumn("text", F.when(text.rlike(r"[@+\[({]|[0-9]"), done).otherwise(F.col("text")))
