"""URL filter: host and path rules first, a logistic regression on hashed character n-grams for the rest."""

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: (verdict, host, path): the host and its subdomains, paths that start with the path.
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/")]

#: The labelled table: words that make up hosts of wanted and of unwanted pages, words that both have, and paths, which
#: are the same for both.
WANTED = ("library museum journal school weather garden history science kitchen travel forum council radio theatre physics "
          "archive").split()
UNWANTED = "pills casino bonus viagra singles prizes loans replica cams crypto payday betting bets jackpot pharma escort".split()
SHARED = "free cheap best online daily win hot easy".split()
PATHS = ["en/12", "fr/article/7", "es/noticias/3", "de/seite/9", "blog/post.html", "docs/guide?page=2", "about/", "", "en/5462#top"]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
GRAMS = (2, 3, 4)
FEATURES = 1 << 14


def labelled(spark: SparkSession) -> DataFrame:
    """url, blocked (0.0 or 1.0): some 500 rows, one per host made of two of the words above."""
    rows = []
    for blocked, own in ((0.0, WANTED), (1.0, UNWANTED)):
        pairs = [(x, y) for i, x in enumerate(own) for y in own[i + 1:]] + [(x, y) for x in SHARED for y in own]
        for i, (x, y) in enumerate(pairs):
            host = ("", "www.", "m.", "blog.")[i % 4] + x + ("-", "")[i // 4 % 2] + y
            rows.append((f"https://{host}.example.{'com net org'.split()[i % 3]}/{PATHS[i % len(PATHS)]}", blocked))
    return spark.createDataFrame(rows, "url string, blocked double")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: what follows the first "://" up to "/", "?", "#" or the end, A-Z in lower case. Path: from there up to "?",
    "#" or the end. Both are empty for null and for text without "://"."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def matching_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """Struct of the longest rule that fits (length, block before allow, rule); null without one.

    The rules become an expression, so keep them to some hundreds.
    """
    def fits(rule_host, rule_path):
        return ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)

    return F.array_max(F.array(*[
        F.when(fits(h, p), F.struct(F.lit(len(h) + len(p)).alias("length"), F.lit(verdict).alias("verdict"),
                                    F.lit(h + p).alias("rule"))) for verdict, h, p in rules]))


def grams(text: Column, tag: str, n: int) -> Column:
    """Character n-grams of ^text$ with a tag."""
    framed = F.concat(F.lit("^"), text, F.lit("$"))
    places = F.sequence(F.lit(1), F.length(framed) - (n - 1))
    cut = F.transform(places, lambda i: F.concat(F.lit(f"{tag}{n}:"), F.substring(framed, i, n)))
    return F.when(F.length(framed) >= n, cut).otherwise(F.array().cast("array<string>"))


def with_grams(df: DataFrame, host: str, path: str, out: str) -> DataFrame:
    return df.withColumn(out, F.concat(*[grams(F.col(c), tag, n) for c, tag in ((host, "h"), (path, "p")) for n in GRAMS]))


def train(table: DataFrame, features: int = FEATURES, penalty: float = 0.01) -> PipelineModel:
    """Logistic regression on a small table of url and blocked. The n-grams are hashed to `features` columns."""
    host, path = host_and_path(F.col("url"))
    rows = with_grams(table.select(host.alias("url_host"), path.alias("url_path"), F.col("blocked").cast("double").alias("blocked")),
                      "url_host", "url_path", "url_grams")
    hashing = HashingTF(inputCol="url_grams", outputCol="url_features", numFeatures=features, binary=True)
    regression = LogisticRegression(featuresCol="url_features", labelCol="blocked", predictionCol="url_blocked",
                                    rawPredictionCol="url_margin", probabilityCol="url_probability",
                                    regParam=penalty, maxIter=60)
    return PipelineModel([hashing, regression.fit(hashing.transform(rows))])


def judge(pages: DataFrame, model: PipelineModel, rules: list[tuple[str, str, str]] = RULES,
          id_column: str = "page_id", url_column: str = "url") -> DataFrame:
    """id, host, path, rule, verdict: a row per input row, repeated rows and null ids included.

    The longest rule that fits gives the verdict; on equal length block wins, then the later rule by text. Without a
    rule the model gives it; a URL without host and path has no n-grams but those of its frame, and is judged on
    them. Other columns are left out. Rows never move between tasks.
    """
    host, path = host_and_path(F.col(url_column))
    rows = pages.select(F.col(id_column).alias("url_id"), host.alias("url_host"), path.alias("url_path"))
    scored = model.transform(with_grams(rows, "url_host", "url_path", "url_grams"))
    best = matching_rule(F.col("url_host"), F.col("url_path"), rules)
    by_model = F.when(F.col("url_blocked") == 1.0, "block").otherwise("allow")
    return (scored.withColumn("url_rule", best)
            .select(F.col("url_id").alias(id_column), F.col("url_host").alias("host"), F.col("url_path").alias("path"),
                    F.col("url_rule.rule").alias("rule"),
                    F.coalesce(F.col("url_rule.verdict"), by_model).alias("verdict")))
