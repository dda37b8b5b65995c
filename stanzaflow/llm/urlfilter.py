"""URL filters: rules first, else naive Bayes over segmented host and path words.

Hosts and paths are taken apart with DataFrame functions. A word model splits
concatenated names by the most likely sequence of words (unigram Viterbi). Its
counts are of words that stand apart: in paths, and between hyphens and the like
inside a host's label. A label without such marks may be words run together, so
its own occurrences do not make it a word. The words of urls that a rule decides
train a multinomial naive Bayes; it judges the others.

Every counted word and every token is used. Both counts stay tables: names and
undecided urls are dealt to chunks, and a chunk gets by join just the counts that
its own substrings or tokens ask for.

Defined results: a null url, or one without ``://``, has empty host and path, no
rule, and the verdict of the class priors; without any url that a rule decides,
all odds are even and the verdict is allow; an empty table gives no rows; repeated rows get equal
values; a null page_id is passed on; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch

RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))
#: Candidates of more characters than this are looked up only where a longer word's first ``SHORT`` characters occur.
SHORT = 16
#: Rows of a chunk, and the least number of chunks (so that all tasks have some).
CHUNK, CHUNKS = 2000, 1024
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _rest() -> Column:
    """What follows the first ``://``, else empty."""
    at = F.coalesce(F.locate("://", F.col("url")), F.lit(0))
    return F.when(at > 0, F.expr("substring(url, locate('://', url) + 3)")).otherwise(F.lit(""))


def host() -> Column:
    return F.translate(F.regexp_extract(_rest(), r"^([^/?#]*)", 1), _UPPER, _LOWER)


def path() -> Column:
    return F.regexp_extract(_rest(), r"^[^/?#]*([^?#]*)", 1)


def rule(rules=RULES) -> Column:
    """The longest fitting rule as struct<verdict, rule>, else null."""
    choice = F.lit(None)
    for verdict, text in sorted(rules, key=lambda r: len(r[1])):  # the last that fits is the longest
        name, _, rest = text.partition("/")
        under = (F.col("host") == name) | F.col("host").endswith(f".{name}")
        fits = under & F.col("path").startswith(f"/{rest}")
        choice = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(text).alias("rule"))).otherwise(choice)
    return choice


def labels() -> Column:
    """The delimited words of host (``h``) and path (``p``) in order, as array<struct<kind, name, apart>>.

    ``apart`` is false for what is a whole label of a host.
    """

    def names(text: Column) -> Column:
        return F.filter(F.split(text, r"[^\p{L}\p{N}]+"), lambda name: F.length(name) > 0)

    def of(kind: str, words: Column, apart: Column) -> Column:
        return F.transform(words, lambda name: F.struct(F.lit(kind).alias("kind"), name.alias("name"), apart.alias("apart")))

    hosts = F.transform(F.split("host", r"\."), lambda label: of("h", names(label), F.size(names(label)) > 1))
    return F.concat(F.flatten(hosts), of("p", names(F.lower("path")), F.lit(True)))


def parts(pages: DataFrame, rules=RULES) -> DataFrame:
    rows = pages.select("page_id", "url").select("page_id", host().alias("host"), path().alias("path"))
    return rows.withColumn("ruled", rule(rules))


@dataclass
class Words:
    """Log probabilities of words; an unknown one costs more with each character."""

    log_p: dict[str, float]
    total: float

    def __post_init__(self):
        self.lengths = sorted({len(w) for w in self.log_p})

    def split(self, name: str) -> list[str]:
        """The most likely sequence of words; unknown stretches stay together."""
        if len(name) < 2:
            return [name] if name else []
        new, more = -math.log(max(self.total, 1.0)), -math.log(10.0)
        best, back = [0.0], [0]
        unknown, since = -math.inf, 0  # the best sequence that ends in an unknown word, of any length
        for end in range(1, len(name) + 1):
            unknown, since = max((unknown + more, since), (best[-1] + new + more, end - 1))
            top, at = unknown, since
            for n in self.lengths:
                if n > end:
                    break
                if (known := self.log_p.get(name[end - n : end])) is not None:
                    top, at = max((top, at), (best[end - n] + known, end - n))
            best.append(top)
            back.append(at)
        words, end = [], len(name)
        while end:
            words.append(name[back[end] : end])
            end = back[end]
        return words[::-1]


@dataclass
class Bayes:
    """Multinomial naive Bayes with add-one smoothing; weights are log odds of block."""

    blocked: float
    allowed: float
    prior: float

    def weight(self, n: int = 0, b: int = 0) -> float:
        """Of a token seen ``n`` times in urls that a rule decides, ``b`` times in blocked ones."""
        return math.log((b + 1) / self.blocked) - math.log((n - b + 1) / self.allowed)


def _dealt(by: Column, rows: int) -> Column:
    return F.pmod(F.xxhash64(by), F.lit(max(CHUNKS, -(-rows // CHUNK)))).alias("chunk")


def _asked(dealt: DataFrame, words: DataFrame) -> DataFrame:
    """chunk, word: the substrings of names that can be counted words, of any length.

    All up to ``SHORT`` characters; longer ones where they begin like a word, in the lengths of such words.
    """
    size = F.length("name")
    starts = F.sequence(F.lit(1), size)
    short = F.flatten(
        F.transform(starts, lambda at: F.transform(F.sequence(F.lit(1), F.least(F.lit(SHORT), size - at + 1)), lambda n: F.col("name").substr(at, n)))
    )
    short = dealt.select("chunk", F.explode(short).alias("word"))
    long = words.where(F.length("word") > SHORT).groupBy(F.substring("word", 1, SHORT).alias("first")).agg(F.collect_set(F.length("word")).alias("lengths"))
    tails = dealt.where(size > SHORT).select("chunk", F.explode(F.transform(F.sequence(F.lit(1), size - SHORT), lambda at: F.col("name").substr(at, size))).alias("tail"))
    tails = tails.withColumn("first", F.substring("tail", 1, SHORT)).join(long, "first")
    lengths = F.filter("lengths", lambda n: n <= F.length("tail"))
    long = tails.select("chunk", F.explode(F.transform(lengths, lambda n: F.col("tail").substr(F.lit(1), n))).alias("word"))
    return short.unionByName(long).distinct()


def name_counts(rows: DataFrame) -> DataFrame:
    """All names of hosts and paths: name, n (how often it stands apart), counted (whether the word model has it)."""
    names = rows.select(F.inline(labels())).groupBy("name").agg(F.count_if("apart").alias("n"))
    return names.withColumn("counted", (F.col("n") > 0) & ~F.col("name").rlike("^[0-9]+$"))


def split_names(names: DataFrame) -> DataFrame:
    """name, number (all digits), words; each chunk of names meets the counts of all its substrings."""
    size = names.agg(F.count(F.lit(1)).alias("names"), F.coalesce(F.sum(F.when(F.col("counted"), F.col("n"))), F.lit(0)).alias("total")).first()
    total = float(size["total"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for found, known in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                model = Words({r["word"]: math.log(r["n"] / total) for r in known or ()}, total)
                columns = [pa.array(found, pa.string()), pa.array([x.isdigit() for x in found], pa.bool_())]
                yield pa.RecordBatch.from_arrays([*columns, pa.array([model.split(x) for x in found], pa.list_(pa.string()))], names=["name", "number", "words"])

    dealt = names.select(_dealt(F.col("name"), size["names"]), "name")
    words = names.where("counted").select(F.col("name").alias("word"), "n")
    known = _asked(dealt, words).join(words, "word")
    known = known.groupBy("chunk").agg(F.collect_list(F.struct("word", "n")).alias("known"))
    chunks = dealt.groupBy("chunk").agg(F.collect_list("name").alias("names")).join(known, "chunk", "left")
    return chunks.select("names", "known").mapInArrow(run, "name string, number boolean, words array<string>")


def _token() -> Column:
    words = F.when((F.col("kind") == "p") & F.col("number"), F.array(F.lit("#"))).otherwise(F.col("words"))
    return F.transform(words, lambda w: F.concat("kind", F.lit(":"), w))


def token_counts(rows: DataFrame, splits: DataFrame) -> DataFrame:
    """token, n, b (n in blocked urls), over all urls that a rule decides."""
    ruled = rows.where(F.col("ruled").isNotNull()).select((F.col("ruled.verdict") == "block").cast("long").alias("b"), F.inline(labels())).drop("apart")
    ruled = ruled.groupBy("kind", "name").agg(F.count(F.lit(1)).alias("n"), F.sum("b").alias("b"))
    tokens = ruled.join(splits, "name").select(F.explode(_token()).alias("token"), "n", "b")
    return tokens.groupBy("token").agg(F.sum("n").alias("n"), F.sum("b").alias("b"))


def bayes(urls, tokens: DataFrame) -> Bayes:
    """``urls``: counts n of urls that a rule decides, b of blocked ones."""
    totals = tokens.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("b"), F.lit(0)).alias("b"), F.count(F.lit(1)).alias("v")).first()
    blocked, allowed = totals["b"] + totals["v"] + 1, totals["n"] - totals["b"] + totals["v"] + 1
    return Bayes(blocked, allowed, math.log((urls["b"] + 1) / (urls["n"] - urls["b"] + 1)))


def judge(pages: DataFrame, rules=RULES) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, block_odds (log odds; null if a rule decided)."""
    scratch = Scratch(pages.sparkSession)
    rows = parts(pages, rules)
    splits = scratch.save(split_names(scratch.save(name_counts(rows), "names")), "splits")
    tokens = scratch.save(token_counts(rows, splits), "tokens")
    block = F.col("ruled.verdict") == "block"
    urls = rows.agg(F.count("ruled").alias("n"), F.count_if(block).alias("b"), F.count_if(F.col("ruled").isNull()).alias("open")).first()
    model = bayes(urls, tokens)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for found, names, counts in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                known = {(r["kind"], r["name"]): r["tokens"] for r in names or ()}
                weights = {r["token"]: model.weight(r["n"], r["b"]) for r in counts or ()}
                at = [[t for x in r["labels"] for t in known[x["kind"], x["name"]]] for r in found]
                odds = [model.prior + sum(weights.get(t, unseen) for t in ts) for ts in at]
                columns = [pa.array([r[k] for r in found], t) for k, t in (("page_id", pa.int64()), ("host", pa.string()), ("path", pa.string()))]
                columns += [pa.nulls(len(found), pa.string()), pa.array(["block" if x > 0 else "allow" for x in odds], pa.string())]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(odds, pa.float64())], names=fields)

    unseen, fields = model.weight(), ["page_id", "host", "path", "rule", "verdict", "block_odds"]
    # saved, since the numbers that deal the rows must not change from one reading to the next
    undecided = rows.where(F.col("ruled").isNull()).select(_dealt(F.monotonically_increasing_id(), urls["open"]), "page_id", "host", "path")
    undecided = scratch.save(undecided, "undecided").withColumn("labels", labels())
    names = undecided.select("chunk", F.inline("labels")).drop("apart").distinct().join(splits, "name").select("chunk", "kind", "name", _token().alias("tokens"))
    counts = names.select("chunk", F.explode("tokens").alias("token")).distinct().join(tokens, "token")
    chunks = undecided.groupBy("chunk").agg(F.collect_list(F.struct("page_id", "host", "path", "labels")).alias("urls"))
    chunks = chunks.join(names.groupBy("chunk").agg(F.collect_list(F.struct("kind", "name", "tokens")).alias("names")), "chunk", "left")
    chunks = chunks.join(counts.groupBy("chunk").agg(F.collect_list(F.struct("token", "n", "b")).alias("counts")), "chunk", "left")
    judged = chunks.select("urls", "names", "counts").mapInArrow(run, "page_id long, host string, path string, rule string, verdict string, block_odds double")
    ruled = rows.where(F.col("ruled").isNotNull()).select(
        F.col("page_id").cast("long").alias("page_id"), "host", "path", F.col("ruled.rule").alias("rule"), F.col("ruled.verdict").alias("verdict"), F.lit(None).cast("double").alias("block_odds")
    )
    return ruled.unionByName(judged)
