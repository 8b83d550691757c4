"""URL filters: host and path rules, and for the rest a verdict on the words in a URL.

Names in hosts are often several words run together. Each distinct name is split into the words that make it most
probable, by Viterbi over unigram probabilities; words and path tokens are then scored by multinomial naive Bayes.

The unigram counts are those of a list of ordinary words and of all words that the table's own URLs show on their own
(parts of hyphenated names, path tokens), so they grow with the table. A name looks up only what it can be made of: its
substrings are joined to the counts, and no lexicon is sent to all tasks. Names are segmented once per distinct name, not
once per page. Naive Bayes knows the words of the names listed here; `fit` adds those of labelled URLs.
"""

import math
from collections import Counter, defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorloom.llm.frames import stored

# Fixed values: (host, path prefix, verdict). A rule holds for its host and all hosts below it.
RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]

# Labelled names, words apart: what naive Bayes is trained on, and the first counts of the unigrams.
BLOCKED = """
adult x, adult video, adult chat, adult dating, xxx tube, xxx movies, porn hub, porn videos, free porn, hardcore sex videos, sex cams,
sex shop, hot sex dates, nude girls, nude photos, naked cams, live cams, webcam girls, escort service, escort girls, erotic stories,
cheap pills, buy pills online, diet pills, pills without prescription, cheap viagra, viagra online, viagra shop, cialis pharmacy,
online pharmacy no prescription, steroids for sale, weight loss pills, free bets, sports betting, betting tips, online betting,
bet bonus, best casino, casino bonus, casino games, live casino, online casino slots, online gambling, gambling palace, gambling
bonus, poker win, poker room, online poker, slots jackpot, jackpot city, win money fast, lottery prize winner, roulette win, free
spins, payday loans, fast cash loans, easy credit, instant loans, crypto giveaway, bitcoin doubler, get rich quick, earn money fast,
free followers, buy followers, buy likes, cheap watches replica, replica bags, replica watches, fake id, fake passport, counterfeit
money, warez crack, warez downloads, crack keygen, serial keygen, pirated games, pirate movies, torrent movies free, torrent
downloads, free gift cards, gift card generator, click win prize, prize claim, spam offers, malware download, phishing bank, phishing
kit, hacked accounts, stolen cards, carding forum, verify account login, account suspended verify, ransomware kit, exploit kit,
buy cocaine, buy weed online, guns without license, essay mill, miracle cure, hot singles, meet singles tonight
"""
ALLOWED = """
daily news, city news, world news today, world report, morning post, evening times, open science, science journal, research lab,
research institute, data notes, public library, city library, digital library, school books, primary school, high school, university
press, university college, history museum, art museum, art gallery, music school, music lessons, live music, garden club, cooking
notes, family recipes, healthy food, travel notes, travel guide, weather report, weather today, health info, health service, hospital
care, online pharmacy guide, local sports, sports club, football club, football results, chess club, card games club, video games
review, board games, bird watch, river walks, mountain guide, train times, bus routes, bus company, car repair, bike shop, book shop,
flower shop, home garden, home builders, web design, code notes, open source, software company, free software, linux notes, mail
service, account help, math help, language course, online course, online dictionary, free encyclopedia, photo archive, film review,
movies today, book review, film festival, job search, job center, small business, business school, city council, city bank, savings
bank, bank holiday, credit union, money matters, insurance advice, law office, legal advice, national park, community center, church
choir, animal rescue, pet care, child care, news archive, help forum, support forum, mobile phone guide, video lessons, radio live,
space center, water works, energy saving, climate report, wedding photos, gift ideas, game theory, credit report, loan calculator
"""
# Parts of hosts and paths that are addresses, not names.
STOP = ["www", "com", "org", "net", "html", "htm", "php", "index", "http", "https"]

SMOOTHING = 0.1
# Log odds a URL needs to be blocked; the prior says that most are fine.
PRIOR = math.log(0.2)
# Words up to this length are looked up by all substrings of a name, longer ones by their first letters.
MAX_WORD = 20
# Labelled rows that naive Bayes is fitted on at most, and words it knows from them at most, the most frequent ones.
SAMPLE_ROWS, VOCABULARY = 20_000, 50_000
# Chance of an unknown word of n letters: UNKNOWN_RATE / total / LETTER ** n.
LETTER, UNKNOWN_RATE = 12.0, 10.0


def _names(text: str) -> list[list[str]]:
    return [name.split() for name in text.replace("\n", " ").split(",")]


def listed() -> tuple[Counter, Counter]:
    """Words of the blocked and of the allowed names."""
    return tuple(Counter(w for name in _names(text) for w in name) for text in (BLOCKED, ALLOWED))


def weights(bad: Counter, good: Counter) -> dict[str, float]:
    """Log odds per known word, by multinomial naive Bayes with additive smoothing."""
    words = sorted({*bad, *good})
    of = lambda c: {w: math.log((c[w] + SMOOTHING) / (sum(c.values()) + SMOOTHING * len(words))) for w in words}
    of_bad, of_good = of(bad), of(good)
    return {w: of_bad[w] - of_good[w] for w in words}


def segment(name: str, counts: dict[str, int], total: int) -> list[str]:
    """The most probable words that make up the name; of equally probable splits, the one whose last words are longest."""
    letter, unknown = math.log(LETTER), math.log(UNKNOWN_RATE / total)
    long = defaultdict(list)
    for word in counts:
        start = name.find(word) if len(word) > MAX_WORD else -1
        while start >= 0:
            long[start + len(word)].append(start)
            start = name.find(word, start + 1)
    best: list[tuple[float, int]] = [(0.0, 0)]
    # Where an unknown word best starts does not depend on where it ends. Known words are always likelier than unknown
    # ones of the same letters, so a stretch need not be known to be unknown.
    open_ = (0.0, 0)
    for end in range(1, len(name) + 1):
        choices = [(open_[0] + unknown - end * letter, open_[1])]
        for start in (*range(max(0, end - MAX_WORD), end), *long[end]):
            count = counts.get(name[start:end], 0)
            if count:
                choices.append((best[start][0] + math.log(count / total), -start))
        best.append(max(choices))
        open_ = max(open_, (best[end][0] + end * letter, -end))
    words, end = [], len(name)
    while end:
        start = -best[end][1]
        words.append(name[start:end])
        end = start
    return words[::-1]


def judged_urls(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", weight_of: dict[str, float] | None = None
) -> DataFrame:
    """Per row: `page_id`, `host`, `path`, `rule` (`host` + `path prefix` of the longest rule that fits, else null), `verdict`
    (`allow` or `block`: the rule's, else that of the words), `words` and `score` (null where a rule decides).

    `weight_of` are the words' log odds: those of the listed names, or of `fit`. The host ends at the first `/`, `?`, `#`; A-Z in it are lowered. A null url or one without `://` has an empty host and
    path, no words, and is allowed. Null identifiers and repeated rows are judged like others; other columns are ignored; an
    empty table gives an empty result.
    """
    rows = _parts(pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url")), ["page_id"])
    rows = rows.withColumn("rule", _rule())
    # What the words are taken from: names by name, and a path's tokens once per distinct path of a host.
    open_ = rows.where("rule is null")
    names = stored(open_.select("host", "path").distinct().select("host", "path", F.explode(_tokens()).alias("token")))
    weight_of = weights(*listed()) if weight_of is None else weight_of
    scores = _scores(names, _segmented(rows, names, weight_of))
    # Pages that a rule decides need no words and are not shuffled.
    decided = rows.where("rule is not null").withColumns(
        {"words": F.lit(None).cast("string"), "score": F.lit(None).cast("double")}
    )
    judged = decided.unionByName(open_.join(scores, ["host", "path"], "left"))
    bad = F.coalesce(F.col("score"), F.lit(PRIOR)) > 0
    by_rule = F.lit(None).cast("string")
    for host, path, verdict in RULES:
        by_rule = F.when(F.col("rule") == host + path, F.lit(verdict)).otherwise(by_rule)
    return judged.select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce(by_rule, F.when(bad, "block").otherwise("allow")).alias("verdict"),
        F.when(F.col("rule").isNull(), F.col("words")).alias("words"),
        F.when(F.col("rule").isNull(), F.coalesce("score", F.lit(PRIOR))).alias("score"),
    )


def fit(labelled: DataFrame, url_col: str = "url", blocked_col: str = "blocked") -> dict[str, float]:
    """Log odds per word from labelled URLs and the listed names: at most SAMPLE_ROWS of them, chosen by hash, and the
    VOCABULARY most frequent words of those. Rows without a label are left out.
    """
    rows = labelled.select(F.col(url_col).alias("url"), F.col(blocked_col).cast("boolean").alias("blocked"))
    rows = rows.where("blocked is not null").orderBy(F.xxhash64("url"), "url", "blocked").limit(SAMPLE_ROWS)
    rows = stored(_parts(rows, ["blocked"]))
    names = stored(rows.select("blocked", F.explode(_tokens()).alias("token")))
    words = names.join(_segmented(rows, names, {}), "token").select("blocked", F.explode("words").alias("word"))
    counts = words.groupBy("word").agg(F.count_if("blocked").alias("bad"), F.count_if(~F.col("blocked")).alias("good"))
    bad, good = listed()
    for row in counts.orderBy(F.desc(F.col("bad") + F.col("good")), "word").limit(VOCABULARY).collect():
        bad[row["word"]] += row["bad"]
        good[row["word"]] += row["good"]
    return weights(bad, good)


def _parts(rows: DataFrame, keep: list[str]) -> DataFrame:
    url = F.coalesce(F.col("url"), F.lit(""))
    part = lambda i: F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)", i)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return rows.select(*keep, F.translate(part(1), upper, lower).alias("host"), part(2).alias("path"))


def _rule() -> Column:
    found = F.lit(None).cast("string")
    for host, path, _ in sorted(RULES, key=lambda r: len(r[0] + r[1])):
        fits = (F.col("host") == host) | F.col("host").endswith(f".{host}")
        found = F.when(fits & F.col("path").startswith(path), F.lit(host + path)).otherwise(found)
    return found


def _split(column: str) -> Column:
    """Runs of letters, lowered."""
    return F.filter(F.split(F.lower(column), r"[^\p{L}]+"), lambda t: F.length(t) > 0)


def _tokens() -> Column:
    """Names of the host and tokens of the path, without parts that are only addresses."""
    both = F.concat(_split("host"), _split("path"))
    return F.filter(both, lambda t: ~t.isin(*STOP))


def _segmented(rows: DataFrame, names: DataFrame, weight_of: dict[str, float]) -> DataFrame:
    """Per distinct token: its words and the sum of their weights."""
    spark = rows.sparkSession
    labels = rows.select(F.explode(F.split("host", r"\.")).alias("label")).where("label like '%-%'")
    alone = labels.select(F.explode(_split("label")).alias("word"))
    alone = alone.union(rows.select(F.explode(_split("path")).alias("word")))
    bad, good = listed()
    base = spark.createDataFrame(sorted((bad + good).items()), "word string, n bigint")
    counts = alone.groupBy("word").agg(F.count("*").alias("n"))
    # A listed word counts as if it had been seen that often: what the table adds refines it.
    counts = stored(counts.union(base.withColumn("n", F.col("n") * 100)).groupBy("word").agg(F.sum("n").alias("n")))
    total = counts.agg(F.sum("n")).first()[0]
    tokens = names.select("token").distinct()
    starts = F.sequence(F.lit(1), F.length("token"))
    cuts = tokens.select("token", F.explode(starts).alias("start")).where("start <= length(token)")
    widths = F.sequence(F.lit(1), F.least(F.lit(MAX_WORD), F.length("token") - F.col("start") + 1))
    parts = cuts.select("token", "start", F.explode(widths).alias("width"))
    parts = parts.select("token", F.expr("substring(token, start, width)").alias("word")).distinct()
    # Short words are found as such, longer ones by their first letters and then compared in full.
    short = parts.join(counts, "word").select("token", "word", "n")
    longer = counts.where(F.length("word") > MAX_WORD)
    longer = longer.select(F.expr(f"left(word, {MAX_WORD})").alias("first"), F.col("word").alias("full"), "n")
    long = parts.join(longer, F.col("word") == F.col("first")).where(F.contains("token", "full"))
    found = short.union(long.select("token", F.col("full").alias("word"), "n"))
    known = found.groupBy("token").agg(F.map_from_entries(F.collect_list(F.struct("word", "n"))).alias("counts"))
    tokens = tokens.join(known, "token", "left")

    def split(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            words = [segment(t, c or {}, total) for t, c in zip(frame["token"], frame["counts"])]
            sums = [sum(weight_of.get(w, 0.0) for w in found) for found in words]
            yield pd.DataFrame({"token": frame["token"], "words": words, "weight": sums})

    return tokens.mapInPandas(split, "token string, words array<string>, weight double")


def _scores(names: DataFrame, segmented: DataFrame) -> DataFrame:
    """Per host and path: `words` and `score`, the log odds that it is to be blocked."""
    joined = names.groupBy("host", "path", "token").agg(F.count("*").alias("times")).join(segmented, "token")
    return joined.groupBy("host", "path").agg(
        F.array_join(F.array_sort(F.collect_list(F.array_join("words", " "))), " ").alias("words"),
        (F.sum(F.col("times") * F.col("weight")) + F.lit(PRIOR)).alias("score"),
    )
