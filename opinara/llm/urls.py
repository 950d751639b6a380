"""URL filter: rules first, then a ratio of two character language models.

Method. Urls that a rule allows or blocks teach two Markov models of characters,
one of accepted and one of rejected urls. Both are of variable order: the
probability of a character after its ``ORDER`` predecessors is interpolated with
that after one fewer, down to a uniform guess, so a context that was never seen
falls back to the longest one that was. A url's score is the difference of the
two log-likelihoods divided by its number of characters. Of the taught urls a
part chosen by hash is left out of the counts; the scores of its accepted and
rejected urls set the threshold, weighing their means by each other's spread.

On Spark. DataFrame functions only. Counts cover every taught url and are summed
before the shuffle; a model has at most as many rows as there are distinct short
character strings. Each distinct string gets its log ratio once; the characters
of distinct urls then meet it in one join. One row (means, spreads) reaches the
driver.

Defined results. The models see host and path only; urls that differ only after
``?`` or ``#`` have equal verdicts. A null url, or one without ``://``, has an empty host and path
and is scored as an empty text. Equal urls have equal verdicts. If no url or only
one kind is taught, the threshold is 0, which allows a score of 0. Of rules of
equal length the first in alphabetical order wins. A very long url is scored whole, with
a row per character. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinara.llm.common import stored

#: Rules as host and path, with their verdict.
RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}
#: Characters before the one that is predicted.
ORDER = 3
#: Weight of the shorter context in the interpolation, and the number of characters a uniform guess is over.
SMOOTH = 4.0
ALPHABET = 128.0
#: Texts whose MD5 begins with a digit below this one calibrate.
CALIBRATE = "4"
START, END = "\x02", "\x03"
#: Characters that are cut into strings together; cutting takes time in the square of it.
CHUNK = 256

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host in lower case and path of a url; empty where there is no ``://``."""
    found = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(found > 0, F.substring(url, found + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), "^[^?#]*", 0)
    return F.translate(host, UPPER, LOWER), path


def fitting_rule(host: Column, path: Column, rules: list[str]) -> Column:
    """The longest rule whose host is the url's or a parent of it and whose path begins the url's; else null."""
    fits = []
    for rule in sorted(rules, key=lambda r: (-len(r), r)):
        name, slash, start = rule.partition("/")
        same = (host == name) | host.endswith("." + name)
        fits.append(F.when(same & path.startswith(slash + start), F.lit(rule)))
    return F.coalesce(*fits, F.lit(None).cast("string"))


def strings(texts: DataFrame, *keep: str, column: str = "text") -> DataFrame:
    """A row per character of each text and one for its end: ``string``, the character after its context."""
    whole = F.concat(F.lit(START * ORDER), F.col(column), F.lit(END))
    texts = texts.select(*keep, whole.alias("whole"), (F.length(column) + 1).alias("characters"))
    at = F.explode(F.sequence(F.lit(0), F.col("characters") - 1, F.lit(CHUNK)))
    texts = texts.select(*keep, "characters", "whole", at.alias("at"))
    chunk = F.substring("whole", F.col("at") + 1, F.lit(CHUNK + ORDER))
    texts = texts.select(*keep, "characters", chunk.alias("chunk"))
    own = F.transform(
        F.sequence(F.lit(1), F.length("chunk") - ORDER), lambda i: F.substring(F.col("chunk"), i, F.lit(ORDER + 1))
    )
    return texts.select(*keep, "characters", F.explode(own).alias("string"))


def log_ratios(wanted: DataFrame, counts: DataFrame) -> DataFrame:
    """``string, ratio`` for each wanted ``string``: log of its last character's probability, accepted less rejected.

    ``counts`` has ``string, accepted, rejected``.
    """
    kinds = ("accepted", "rejected")
    totals = counts.agg(*[F.coalesce(F.sum(k), F.lit(0)).alias(k) for k in kinds]).first()
    found = wanted
    guess = dict.fromkeys(kinds, F.lit(1 / ALPHABET))
    for order in range(ORDER + 1):
        tail = F.substring("string", ORDER + 1 - order, order + 1)
        seen = counts.groupBy(tail.alias("tail")).agg(*[F.sum(k).alias(f"n_{k}") for k in kinds])
        found = found.withColumn("tail", tail).join(seen, "tail", "left").drop("tail")
        if order:
            context = F.substring("string", ORDER + 1 - order, order)
            before = counts.groupBy(context.alias("context")).agg(*[F.sum(k).alias(f"of_{k}") for k in kinds])
            found = found.withColumn("context", context).join(before, "context", "left").drop("context")
        made = {}
        for k in kinds:
            n, of = F.coalesce(f"n_{k}", F.lit(0)), F.coalesce(f"of_{k}", F.lit(0)) if order else F.lit(totals[k])
            made[f"p_{k}"] = (n + SMOOTH * guess[k]) / (of + SMOOTH)
        found = found.select("string", *[c.alias(name) for name, c in made.items()])
        guess = {k: F.col(f"p_{k}") for k in kinds}
    return found.select("string", (F.log("p_accepted") - F.log("p_rejected")).alias("ratio"))


def scored(texts: DataFrame, counts: DataFrame) -> DataFrame:
    """``text, score`` for each distinct ``text``."""
    own = strings(texts, "text")
    ratios = stored(log_ratios(own.select("string").distinct(), counts), "log-ratios")
    score = F.sum("ratio") / F.max("characters")
    return own.join(ratios, "string").groupBy("text").agg(score.alias("score"))


def threshold(samples: DataFrame) -> float:
    """The score from which a url is accepted, from ``accepted`` (0 or 1) and ``score`` of calibration urls."""
    row = samples.agg(
        *[
            f(F.when(F.col("accepted") == k, F.col("score"))).alias(f"{name}{k}")
            for name, f in (("mean", F.avg), ("spread", F.stddev_pop))
            for k in (0, 1)
        ]
    ).first()
    if row.mean0 is None or row.mean1 is None:
        return 0.0
    spread = row.spread0 + row.spread1
    if spread == 0:
        return (row.mean0 + row.mean1) / 2
    return (row.mean0 * row.spread1 + row.mean1 * row.spread0) / spread


def judge(pages: DataFrame, rules: dict[str, str] | None = None, key: str = "page_id", url: str = "url") -> DataFrame:
    """``page_id, host, path, rule, verdict`` for every row of ``pages``."""
    rules = RULES if rules is None else rules
    host, path = host_and_path(F.col(url))
    rows = pages.select(F.col(key).alias("page_id"), host.alias("host"), path.alias("path"))
    rows = rows.withColumn("rule", fitting_rule(F.col("host"), F.col("path"), list(rules)))
    said = F.lit(None).cast("string")
    for rule, verdict in rules.items():
        said = F.when(F.col("rule") == rule, verdict).otherwise(said)
    rows = rows.withColumn("said", said).withColumn("text", F.concat("host", "path"))

    # A path is empty or begins with a slash, so equal texts have equal hosts, paths and rules.
    accepted = F.max(F.when(F.col("said") == "allow", 1).when(F.col("said") == "block", 0)).alias("accepted")
    texts = stored(rows.groupBy("text").agg(accepted, F.count(F.when(F.col("said").isNull(), 1)).alias("open")), "urls")
    calibrates = F.substring(F.md5(F.col("text").cast("binary")), 1, 1) < CALIBRATE
    taught = texts.filter(F.col("accepted").isNotNull() & ~calibrates)
    counts = strings(taught, "accepted").groupBy("string").agg(
        F.sum(F.col("accepted").cast("long")).alias("accepted"), F.sum(1 - F.col("accepted").cast("long")).alias("rejected")
    )
    counts = stored(counts, "character-counts")
    wanted = texts.filter((F.col("open") > 0) | (F.col("accepted").isNotNull() & calibrates))
    scores = stored(scored(wanted, counts), "url-scores")
    known = scores.join(texts.filter(F.col("accepted").isNotNull() & calibrates), "text")
    limit = threshold(known)
    method = F.when(F.col("score") >= limit, "allow").otherwise("block")
    judged = rows.join(scores, "text", "left")
    return judged.select("page_id", "host", "path", "rule", F.coalesce("said", method).alias("verdict"))


def _order_sql(order: int) -> str:
    """Adds the probabilities of one order to those of the order below."""
    tail, context = f"substr(string, {ORDER + 1 - order})", f"substr(string, {ORDER + 1 - order}, {order})"
    before = f"p{order - 1}" if order else "wanted"
    guesses = ("a", "r") if order else (f"1.0::double / {ALPHABET}", f"1.0::double / {ALPHABET}")
    return f"""
s{order} as (select {tail} as tail, sum(accepted) as na, sum(rejected) as nr from counts group by 1),
c{order} as (select {context} as context, sum(accepted) as oa, sum(rejected) as orr from counts group by 1),
p{order} as (
  select string, (coalesce(na, 0) + {SMOOTH}::double * {guesses[0]}) / (coalesce(oa, 0) + {SMOOTH}::double) as a,
    (coalesce(nr, 0) + {SMOOTH}::double * {guesses[1]}) / (coalesce(orr, 0) + {SMOOTH}::double) as r
  from {before} left join s{order} on {tail} = s{order}.tail left join c{order} on {context} = c{order}.context)"""


def _rule_sql(rules: dict[str, str], made) -> str:
    cases = []
    for rule in sorted(rules, key=lambda r: (-len(r), r)):
        name, slash, start = rule.partition("/")
        fits = f"(host = '{name}' or ends_with(host, '.{name}')) and starts_with(path, '{slash}{start}')"
        cases.append(f"when {fits} then {made(rule)}")
    return "case " + " ".join(cases) + " end"


URLS_SQL = f"""
with cut as (select page_id, case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end as rest from pages),
parts as (select page_id, rest, regexp_extract(rest, '^[^/?#]*') as raw from cut),
named as (
  select page_id, translate(raw, '{UPPER}', '{LOWER}') as host, regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') as path
  from parts),
judged as (
  select *, {_rule_sql(RULES, lambda r: f"'{r}'")} as rule, {_rule_sql(RULES, lambda r: f"'{RULES[r]}'")} as said, host || path as text
  from named),
texts as (
  select text, max(case said when 'allow' then 1 when 'block' then 0 end) as accepted, count(*) filter (said is null) as open_rows,
    substr(md5(text), 1, 1) < '{CALIBRATE}' as calibrates
  from judged group by text),
strings as (
  select text, accepted, open_rows, calibrates, substr(whole, i, {ORDER + 1}) as string
  from (select *, repeat(chr(2), {ORDER}) || text || chr(3) as whole, unnest(range(1, length(text) + 2)) as i from texts)),
counts as (
  select string, sum(accepted) as accepted, sum(1 - accepted) as rejected
  from strings where accepted is not null and not calibrates group by string),
wanted as (select distinct string from strings where open_rows > 0 or accepted is not null and calibrates),
{",".join(_order_sql(k) for k in range(ORDER + 1))},
scores as (
  select text, any_value(accepted) as accepted, any_value(calibrates) as calibrates, sum(ln(a) - ln(r)) / count(*) as score
  from strings join p{ORDER} using (string) group by text),
spreads as (
  select avg(score) filter (accepted = 0) as m0, avg(score) filter (accepted = 1) as m1,
    stddev_pop(score) filter (accepted = 0) as s0, stddev_pop(score) filter (accepted = 1) as s1
  from scores where accepted is not null and calibrates),
bound as (
  select case when m0 is null or m1 is null then 0 when s0 + s1 = 0 then (m0 + m1) / 2
    else (m0 * s1 + m1 * s0) / (s0 + s1) end as least
  from spreads)
select page_id, host, path, rule, coalesce(said, case when score >= (select least from bound) then 'allow' else 'block' end) as verdict
from judged left join scores using (text)
"""
