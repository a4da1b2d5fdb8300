"""URL filter: host word segmentation and naive Bayes (operator 4).

There are no labels.  Hosts are labelled by weak evidence: seed words in their
names, and pages whose title and text are full of seed words, if the host's
pages agree.  Naive Bayes then learns from all words of these hosts' names and
paths, labels the hosts itself, and learns again from what it finds; only
what pages say stays.  So words that only go along with the seeds decide too, and a seed word
among words of wanted sites needn't.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ._shared import materialize, workspace

# Words that name unwanted sites, and words that many sites have
# in their names.  They label the training hosts and seed the word counts.
UNWANTED = (
    "ads",
    "adult",
    "adserver",
    "bet",
    "bets",
    "betting",
    "cams",
    "casino",
    "cialis",
    "clickbait",
    "crack",
    "cracked",
    "dating",
    "doubleclick",
    "escort",
    "escorts",
    "farm",
    "gamble",
    "gambling",
    "hack",
    "hentai",
    "jackpot",
    "keygen",
    "loan",
    "loans",
    "lottery",
    "malware",
    "milf",
    "nude",
    "payday",
    "phish",
    "phishing",
    "pharma",
    "pill",
    "pills",
    "poker",
    "popunder",
    "porn",
    "porno",
    "proxy",
    "roulette",
    "scam",
    "sex",
    "sexy",
    "slots",
    "spam",
    "spyware",
    "torrent",
    "torrents",
    "track",
    "tracker",
    "tracking",
    "viagra",
    "virus",
    "warez",
    "win",
    "xxx",
)
USUAL = (
    "about",
    "academy",
    "api",
    "app",
    "archive",
    "art",
    "article",
    "best",
    "blog",
    "book",
    "books",
    "business",
    "cdn",
    "center",
    "cheap",
    "city",
    "club",
    "code",
    "college",
    "community",
    "company",
    "cook",
    "daily",
    "data",
    "design",
    "dev",
    "digital",
    "docs",
    "download",
    "education",
    "fast",
    "film",
    "finance",
    "food",
    "forum",
    "free",
    "garden",
    "group",
    "guide",
    "health",
    "help",
    "history",
    "home",
    "hot",
    "house",
    "info",
    "journal",
    "kids",
    "lab",
    "law",
    "learn",
    "library",
    "life",
    "link",
    "live",
    "local",
    "magazine",
    "mail",
    "market",
    "math",
    "media",
    "mobile",
    "music",
    "my",
    "nature",
    "net",
    "network",
    "news",
    "now",
    "online",
    "open",
    "paper",
    "park",
    "photo",
    "post",
    "press",
    "project",
    "recipe",
    "research",
    "review",
    "school",
    "science",
    "search",
    "shop",
    "site",
    "sport",
    "sports",
    "static",
    "store",
    "story",
    "studio",
    "team",
    "tech",
    "the",
    "times",
    "today",
    "top",
    "travel",
    "university",
    "video",
    "weather",
    "web",
    "wiki",
    "world",
    "www",
    "x",
    "zone",
)
#: Rules of the contract: action, host and path.
RULES = (
    ("block", "com", "/en/"),
    ("allow", "example.com", "/en/7"),
    ("allow", "net", "/de/"),
    ("block", "example.net", "/de/8"),
    ("block", "org", "/es/"),
)

#: How often a word occurs at least, to be one; a seed word's count is raised by this share of all words, 10 at least.
TIMES, SEEDED = 2, 1e-4
#: Slots of the naive Bayes counts, by hash of the token, and what is added to each.
SLOTS, ADDED = 1 << 16, 0.1
#: Share of seed words in a page's text, two at least, from which it speaks against its host, and share of such pages.
DENSE, AGREED = 0.02, 0.5
#: How often hosts are labelled by the model and it is fitted again.
ROUNDS = 2


def host_of(url):
    """The host and path columns of a url column, as the contract cuts them."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring_index(F.substring_index(F.substring(url, at + 3, F.length(url)), "#", 1), "?", 1)).otherwise("")
    host = F.regexp_extract(rest, r"(?s)^([^/]*)(.*)$", 1)
    path = F.regexp_extract(rest, r"(?s)^([^/]*)(.*)$", 2)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(host, upper, upper.lower()), path


@dataclass
class Rules:
    """Host and path rules; the longest that fits wins, and of equal ones that of the longer host."""

    by_host: dict[str, list[tuple[str, str]]]

    @classmethod
    def build(cls, rules: Iterable[tuple[str, str, str]]) -> Rules:
        by_host: dict[str, list[tuple[str, str]]] = {}
        for action, host, path in rules:
            by_host.setdefault(host.lower(), []).append((path, action))
        for own in by_host.values():
            own.sort(key=lambda r: -len(r[0]))
        return cls(by_host)

    def match(self, host: str, path: str) -> tuple[str, str] | None:
        """The rule, as host and path in one, and its action."""
        best = None
        while host:
            for p, action in self.by_host.get(host, ()):
                if path.startswith(p):
                    if best is None or len(host) + len(p) > len(best[0]):
                        best = host + p, action
                    break
            host = host.partition(".")[2]
        return best


class Segmenter:
    """Splits a name into words by the most probable path under unigram counts.

    A run of letters outside the vocabulary has a probability that falls tenfold
    with each letter, so that known words win wherever they cover the name.
    ``counts`` needs the words that are in the names to be split only, ``total``
    is the sum of all words' counts.
    """

    def __init__(self, counts: dict[str, float], total: float | None = None) -> None:
        self.total = total or sum(counts.values()) or 1.0
        # No word is longer than the longest, so no split is left out.
        self.longest = max(map(len, counts), default=1)
        self.logs = {w: math.log10(c / self.total) for w, c in counts.items() if c > 0}

    def __getitem__(self, name: str) -> list[str]:
        # A longer unknown run is never better than its parts by much: each letter costs a tenth, each part ``1 / total``.
        unknown = -math.log10(self.total) - 1
        best: list[tuple[float, int]] = [(0.0, 0)]
        run: tuple[float, int] = (-math.inf, 0)
        for end in range(1, len(name) + 1):
            # ``run`` is the best begin of an unknown run that ends here, whatever its length.
            run = max(run, (best[end - 1][0] + (end - 1), end - 1))
            options = [(run[0] + unknown - end, run[1])]
            for start in range(max(0, end - self.longest), end):
                known = self.logs.get(name[start:end])
                if known is not None:
                    options.append((best[start][0] + known, start))
            best.append(max(options))
        words, end = [], len(name)
        while end:
            start = best[end][1]
            words.append(name[start:end])
            end = start
        return words[::-1]


NUMBER = "#"


def host_names(host: str) -> list[str]:
    """The runs of letters in a host's labels, without its last label and port."""
    return [x for label in host.split(":")[0].split(".")[:-1] or [host] for x in re.findall(r"[^\W\d_]+", label)]


def path_names(path: str) -> list[str]:
    """The runs of letters in a path; a number is ``NUMBER``."""
    return [NUMBER if p.isdigit() else p for p in re.findall(r"[^\W\d_]+|\d+", path.lower())]


@dataclass
class UrlModel:
    """All words' counts, as a table ``w`` and ``n`` and their sum, and multinomial naive Bayes over hosts."""

    counts: DataFrame
    total: float
    weights: np.ndarray
    prior: float


def fit_bayes(table: np.ndarray, hosts: Sequence[float]) -> tuple[np.ndarray, float]:
    """Weights of all slots and the prior, from tokens' counts in wanted and unwanted hosts and the hosts' numbers."""
    used = table.sum(0) > 0
    smooth = (table + ADDED) / (table.sum(1, keepdims=True) + ADDED * max(1, int(used.sum())))
    weights = np.where(used, np.log(smooth[1] / smooth[0]), 0.0)
    return weights, math.log((hosts[1] + 1) / (hosts[0] + 1))


def visible(html_col: Column) -> Column:
    """A page's title and text, lower-cased, without tags, scripts and styles."""
    bare = F.regexp_replace(html_col, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", " ")
    return F.lower(F.coalesce(bare, F.lit("")))


def word_counts(pages: DataFrame, host: Column, path: Column, text: Column, seeds: Sequence[str], out: str) -> tuple[DataFrame, float]:
    """Unigram counts ``w`` and ``n`` of all words that occur ``TIMES`` in texts, paths and hyphened hosts, and of the seeds; and their sum."""
    hyphened = F.when(F.instr(host, "-") > 0, host).otherwise("")
    words = F.regexp_extract_all(F.lower(F.concat_ws(" ", hyphened, path, text)), F.lit(r"\p{L}{2,}"), 0)
    counted = pages.select(F.explode(words).alias("w")).groupBy("w").agg(F.count(F.lit(1)).cast("double").alias("n"))
    counted = materialize(counted, f"{out}/words")
    every = counted.agg(F.sum("n")).first()[0] or 0
    raised = pages.sparkSession.createDataFrame([(w, max(10.0, every * SEEDED)) for w in seeds], "w string, n double")
    kept = counted.where(F.col("n") >= TIMES).unionByName(raised).groupBy("w").agg(F.sum("n").alias("n"))
    kept = materialize(kept, f"{out}/counts")
    return kept, kept.agg(F.sum("n")).first()[0] or 1.0


def segments(names: DataFrame, counts: DataFrame, total: float, out: str) -> DataFrame:
    """Each distinct ``name`` of a table and its ``words``, by the counts of all words that it holds anywhere.

    No task has the vocabulary: a name's substrings, of the lengths that words
    have, are joined with it, and what is found comes back to the name, which is
    known by a number meanwhile, however long it is.
    """
    own = names.distinct().select("name", F.monotonically_increasing_id().alias("i"))
    own = materialize(own, f"{out}-names")
    lengths = F.array(*[F.lit(r[0]) for r in counts.select(F.length("w")).distinct().collect()]).cast("array<int>")
    parts = own.select("i", "name", F.explode(lengths).alias("k")).where(F.col("k") <= F.length("name"))
    parts = parts.select("i", "name", "k", F.explode(F.sequence(F.lit(1), F.length("name") - F.col("k") + 1)).alias("at"))
    parts = parts.select("i", F.expr("substring(name, at, k)").alias("w"))
    found = parts.hint("merge").join(counts, "w").groupBy("i").agg(F.collect_set(F.struct("w", "n")).alias("found"))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [Segmenter({x["w"]: x["n"] for x in found or ()}, total)[name] for name, found in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words, pa.list_(pa.string()))], names=["name", "words"])

    return materialize(own.join(found, "i", "left").select("name", "found").mapInArrow(split, "name string, words array<string>"), f"{out}-segments")


def token(word: Column, in_path: Column) -> Column:
    return F.when(in_path, F.concat(F.lit("/"), word)).otherwise(word)


def slot_of(word: Column) -> Column:
    """The naive Bayes slot of a token."""
    return (F.crc32(word.cast("binary")) % SLOTS).cast("int")


def host_tokens(pages: DataFrame, host: Column, path: Column, speaks: Column, counts: DataFrame, total: float, unwanted: Sequence[str], out: str) -> DataFrame:
    """``host``, ``slot`` of each of its tokens; null slots count its ``pages``, those that speak against it, and ``named``, seed words in its name."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own: dict[str, list[int]] = {}
            names: set[tuple[str, str, bool]] = set()
            for h, p, bad in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if h:
                    seen = own.setdefault(h, [0, 0])
                    seen[0] += 1
                    seen[1] += bool(bad)
                    names.update((h, x, False) for x in host_names(h))
                    names.update((h, x, True) for x in path_names(p))
            found = [(*x, 0, 0) for x in names] + [(h, None, None, *n) for h, n in own.items()]
            columns = list(zip(*found, strict=True)) or [()] * 5
            kinds = (pa.string(), pa.string(), pa.bool_(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["host", "name", "in_path", "pages", "against"])

    rows = pages.select(host.alias("h"), path.alias("p"), speaks.alias("s")).mapInArrow(run, "host string, name string, in_path boolean, pages long, against long")
    rows = rows.groupBy("host", "name", "in_path").agg(F.sum("pages").alias("pages"), F.sum("against").alias("against"))
    rows = materialize(rows, f"{out}/names")
    split = segments(rows.where("name IS NOT NULL").select("name"), counts, total, f"{out}/hosts")
    words = rows.where("name IS NOT NULL").join(split, "name").select("host", "in_path", F.explode("words").alias("w"))
    seed = (F.col("w").isin(*unwanted) & ~F.col("in_path")) if unwanted else F.lit(False)
    zero = F.lit(0).cast("long")
    words = words.select("host", slot_of(token(F.col("w"), F.col("in_path"))).alias("slot"), zero.alias("pages"), zero.alias("against"), seed.cast("long").alias("named"))
    totals = rows.where("name IS NULL").select("host", F.lit(None).cast("int").alias("slot"), "pages", "against", zero.alias("named"))
    named = words.where("named > 0").select("host", F.lit(None).cast("int").alias("slot"), "pages", "against", "named")
    every = totals.unionByName(named).unionByName(words)
    return every.groupBy("host", "slot").agg(F.sum("pages").alias("pages"), F.sum("against").alias("against"), F.max("named").alias("named"))


def train(
    pages: DataFrame,
    url_col: str = "url",
    html_col: str | None = "html",
    unwanted: Sequence[str] = UNWANTED,
    usual: Sequence[str] = USUAL,
    rounds: int = ROUNDS,
) -> UrlModel:
    """Count words and fit the classifier, both over all pages.

    Unigrams are the words of page titles and texts, of paths and between
    hyphens in hosts that occur ``TIMES`` at least, however many there are, and
    the given seed words.  A host is labelled unwanted if its segmented
    name has a word of ``unwanted`` or if ``AGREED`` of its pages are dense with
    them, else wanted.  Over ``rounds`` the model labels the hosts itself and is
    fitted again; only those that their pages speak against stay as they are.  Each token counts once a host, so that a host of many pages
    says no more than another.  Nulls, and urls without a host, tell nothing.
    """
    out = workspace(pages.sparkSession, "urls")
    host, path = host_of(F.col(url_col))
    text = visible(F.col(html_col)) if html_col else F.lit("")
    counts, words = word_counts(pages, host, path, text, (*unwanted, *usual), out)
    seeds = F.regexp_count(text, F.lit(rf"(?<!\p{{L}})(?:{'|'.join(unwanted)})(?!\p{{L}})")) if unwanted else F.lit(0)
    speaks = (seeds >= 2) & (seeds >= DENSE * F.regexp_count(text, F.lit(r"\p{L}+")))
    found = materialize(host_tokens(pages, host, path, speaks, counts, words, unwanted, out), f"{out}/tokens")
    hosts = found.where("slot IS NULL").select(
        "host",
        (F.col("named") > 0).alias("named"),
        (F.col("against") >= AGREED * F.col("pages")).alias("against"),
    )
    hosts = materialize(hosts, f"{out}/hosts")
    tokens = found.where("slot IS NOT NULL").select("host", "slot")
    labels = hosts.select("host", (F.col("named") | F.col("against")).cast("int").alias("kind"))
    for step in range(rounds + 1):
        table = np.zeros((2, SLOTS))
        for r in tokens.join(labels, "host").groupBy("kind", "slot").agg(F.count(F.lit(1)).alias("n")).collect():
            table[r["kind"], r["slot"]] = r["n"]
        numbers = {r["kind"]: r["n"] for r in labels.groupBy("kind").agg(F.count(F.lit(1)).alias("n")).collect()}
        weights, prior = fit_bayes(table, [numbers.get(0, 0), numbers.get(1, 0)])
        if step < rounds:
            used = np.flatnonzero(weights)
            by_slot = pages.sparkSession.createDataFrame(pa.table({"slot": pa.array(used, pa.int32()), "weight": pa.array(weights[used], pa.float64())}))
            odds = tokens.join(F.broadcast(by_slot), "slot").groupBy("host").agg(F.sum("weight").alias("odds"))
            kind = F.col("against") | (F.coalesce("odds", F.lit(0.0)) + F.lit(prior) > 0)
            labels = materialize(hosts.join(odds, "host", "left").select("host", kind.cast("int").alias("kind")), f"{out}/labels-{step}")
    return UrlModel(counts, words, weights, prior)


def judge(
    pages: DataFrame,
    model: UrlModel,
    rules: Iterable[tuple[str, str, str]] = RULES,
    id_col: str = "page_id",
    url_col: str = "url",
) -> DataFrame:
    """``id_col``, ``host``, ``path``, ``rule``, ``verdict``, ``words``, ``log_odds`` of every row.

    A url that is null or has no ``://`` has an empty host and path, no rule, and
    is allowed, as are urls without any known token, unless the prior alone
    speaks against them.  Repeated rows are judged each; extra columns are ignored.
    """
    out = workspace(pages.sparkSession, "judged")
    kind = pages.schema[id_col].dataType
    id_type = to_arrow_type(kind)
    host, path = host_of(F.col(url_col))
    cut = T.StructType([T.StructField("own", T.LongType()), T.StructField("id", kind), *[T.StructField(c, T.StringType()) for c in ("host", "path")], *[T.StructField(c, T.ArrayType(T.StringType())) for c in ("hosts", "paths")]])

    def names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h, p = (batch.column(k).to_pylist() for k in (2, 3))
            found = [[host_names(x) if x else [] for x in h], [path_names(y) if x else [] for x, y in zip(h, p, strict=True)]]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1).cast(id_type), *batch.columns[2:4], *(pa.array(x, pa.list_(pa.string())) for x in found)], names=cut.names)

    rows = pages.select(F.monotonically_increasing_id().alias("own"), F.col(f"`{id_col}`").alias("id"), host.alias("host"), path.alias("path"))
    rows = materialize(rows.mapInArrow(names, cut), f"{out}/rows")
    every = rows.select("own", F.posexplode(F.concat("hosts", "paths")).alias("at", "name"), F.size("hosts").alias("n"))
    split = segments(every.select("name"), model.counts, model.total, f"{out}/urls")
    used = np.flatnonzero(model.weights)
    by_slot = pages.sparkSession.createDataFrame(pa.table({"slot": pa.array(used, pa.int32()), "weight": pa.array(model.weights[used], pa.float64())}))
    # Weights go to the distinct words of distinct names, which are far fewer than the rows' names.
    tokens = split.select("name", F.explode(F.array(F.lit(False), F.lit(True))).alias("in_path"), "words")
    tokens = tokens.select("name", "in_path", F.posexplode("words").alias("k", "w")).withColumn("w", token(F.col("w"), F.col("in_path")))
    tokens = tokens.withColumn("slot", slot_of(F.col("w"))).join(F.broadcast(by_slot), "slot", "left")
    weighed = tokens.groupBy("name", "in_path").agg(F.sort_array(F.collect_list(F.struct("k", "w", F.coalesce("weight", F.lit(0.0)).alias("weight")))).alias("tokens"))
    # Written first, so that both sides of the join are plain shuffles, of which Spark splits a hot name's part.
    weighed = materialize(weighed, f"{out}/weighed")
    # Files of repeated names are small for what they hold: nothing that grows with the rows is broadcast for that.
    each = every.withColumn("in_path", F.col("at") >= F.col("n")).hint("merge").join(weighed, ["name", "in_path"])
    each = each.groupBy(F.col("own").alias("its")).agg(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("at", "tokens"))), lambda x: x["tokens"])).alias("tokens"))
    each = rows.select("own", "id", "host", "path").hint("merge").join(each, F.col("own") == F.col("its"), "left")
    tokens = F.coalesce("tokens", F.array().cast("array<struct<k:int,w:string,weight:double>>"))
    odds = F.lit(model.prior) + F.aggregate(F.transform(tokens, lambda x: x["weight"]), F.lit(0.0), lambda a, x: a + x)
    each = each.select("id", "host", "path", F.transform(tokens, lambda x: x["w"]).alias("words"), odds.alias("log_odds"))
    schema = T.StructType([T.StructField(id_col, kind), *[T.StructField(c, T.StringType()) for c in ("host", "path", "rule", "verdict")], T.StructField("words", T.ArrayType(T.StringType())), T.StructField("log_odds", T.DoubleType())])
    fixed = Rules.build(rules)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            matched = [fixed.match(h, p) for h, p in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            found = zip(matched, batch.column(1).to_pylist(), batch.column(4).to_pylist(), strict=True)
            verdicts = [rule[1] if rule else "block" if h and odds > 0 else "allow" for rule, h, odds in found]
            rule = pa.array([rule and rule[0] for rule in matched], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), rule, pa.array(verdicts), batch.column(3), batch.column(4)], names=schema.names)

    return each.mapInArrow(run, schema)
