"""URL filters: host and path rules, then the ratio of two character language models learnt from what the rules decide."""

from functools import reduce

from pyspark.sql import functions as F

from ..session import settle
from .common import bare

#: Rules as host, path, verdict. A rule holds for its host and all subdomains where the path starts like its own.
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
#: Symbols of the longest context, and the chance of a symbol that no context has seen.
CONTEXT, BASE = 3, 1 / 256
#: One ruled URL in this many calibrates the threshold and teaches nothing.
HELD_OUT = 5
#: Bins for each unit of log-likelihood difference at which a threshold may stand.
BINS = 50

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def parts(url):
    """Host and path columns: both empty for NULL and where there is no ``://``."""
    host = F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def ruled(host, path, rules=RULES):
    """The longest rule that fits, as its text and its verdict; NULL if none does."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule_host, rule_path, says in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        text, verdict = F.when(fits, F.lit(rule_host + rule_path)).otherwise(text), F.when(fits, F.lit(says)).otherwise(verdict)
    return text, verdict


def _grams(text, context):
    """Every symbol of a text with the symbols before it, start marks ahead and an end mark behind.

    The text is cut into symbols once, and the array is laid beside itself shifted by one, two and so on: the work grows with the length.
    """
    symbols = F.regexp_extract_all(F.concat(F.lit("\x02" * context), text, F.lit("\x03")), F.lit("(?s)(.)"), F.lit(1))
    shifted = [F.slice(symbols, F.lit(k + 1), F.length(text) + 1) for k in range(context + 1)]
    return reduce(lambda a, b: F.zip_with(a, b, lambda x, y: F.concat(x, y)), shifted)


def contexts(examples, context=CONTEXT):
    """Counts of the models, one row for each context of 0 to ``context`` symbols: ``before, total_a, kinds_a, total_r, kinds_r, following``.

    ``examples`` has ``text, accepted, n``. Long contexts are counted over all examples, and shorter ones from those counts.
    A context's symbols lie in one map, whose size the alphabet bounds.
    """
    gram = examples.select(F.explode(_grams(F.col("text"), context)).alias("gram"), "accepted", "n")
    long = gram.groupBy("gram").agg(F.sum(F.when(F.col("accepted"), F.col("n")).otherwise(0)).alias("a"),
                                    F.sum(F.when(~F.col("accepted"), F.col("n")).otherwise(0)).alias("r"))
    shorter = long.select(F.explode(F.sequence(F.lit(0), F.lit(context))).alias("k"), "gram", "a", "r").select(
        F.expr(f"substring(gram, {context + 1} - k, k)").alias("before"), F.expr(f"substring(gram, {context + 1}, 1)").alias("symbol"), "a", "r")
    each = shorter.groupBy("before", "symbol").agg(F.sum("a").alias("a"), F.sum("r").alias("r"))
    return each.groupBy("before").agg(
        F.sum("a").alias("total_a"), F.count_if(F.col("a") > 0).alias("kinds_a"), F.sum("r").alias("total_r"), F.count_if(F.col("r") > 0).alias("kinds_r"),
        F.map_from_entries(F.collect_list(F.struct("symbol", F.struct("a", "r")))).alias("following"))


def _smoothed(steps, side):
    """Witten-Bell estimate through the contexts from short to long; a context that was never seen passes the shorter one's on."""
    def longer(chance, s):
        n, total, kinds = F.coalesce(s[side], F.lit(0)), s[f"total_{side}"], s[f"kinds_{side}"]
        return F.when(total > 0, (n + kinds * chance) / (total + kinds)).otherwise(chance)

    return F.aggregate(steps, F.lit(BASE), longer)


def differences(texts, model, context=CONTEXT):
    """``key, score`` of distinct texts ``key, text``: mean over symbols of the log-likelihood under accepted less that under rejected URLs.

    Distinct grams meet the model's contexts in one join; every text then sums its grams, which carry its key and not the text.
    """
    placed = texts.select("key", F.explode(_grams(F.col("text"), context)).alias("gram"))
    grams = placed.select("gram").distinct()
    asked = grams.select("gram", F.explode(F.sequence(F.lit(0), F.lit(context))).alias("k")).withColumn("before", F.expr(f"substring(gram, {context + 1} - k, k)"))
    met = asked.join(model, "before", "left").withColumn("own", F.try_element_at("following", F.expr(f"substring(gram, {context + 1}, 1)")))
    step = F.struct("k", F.col("own.a").alias("a"), F.col("own.r").alias("r"), *[F.coalesce(c, F.lit(0)).alias(c) for c in ("total_a", "kinds_a", "total_r", "kinds_r")])
    chances = met.groupBy("gram").agg(F.array_sort(F.collect_list(step)).alias("steps"))
    weighed = settle(chances.select("gram", (F.ln(_smoothed(F.col("steps"), "a")) - F.ln(_smoothed(F.col("steps"), "r"))).alias("weight")), "grams")
    return placed.join(weighed, "gram").groupBy("key").agg(F.avg("weight").alias("score"))


def calibrate(scored):
    """Threshold bin of the best balanced accuracy on ``bin, accepted, n`` rows; 0 without examples of both kinds."""
    rows = scored.groupBy("bin").agg(F.sum(F.when(F.col("accepted"), F.col("n")).otherwise(0)).alias("a"),
                                     F.sum(F.when(~F.col("accepted"), F.col("n")).otherwise(0)).alias("r")).collect()
    rows = sorted((r["bin"], r["a"], r["r"]) for r in rows)
    accepted, rejected = sum(r[1] for r in rows), sum(r[2] for r in rows)
    if not accepted or not rejected:
        return 0
    below_a, below_r, best = 0, 0, (-1.0, 0)
    for at, a, r in [*rows, (rows[-1][0] + 1, 0, 0)]:
        quality = (accepted - below_a) / accepted + below_r / rejected
        if quality > best[0] + 1e-12:
            best = (quality, at)
        below_a, below_r = below_a + a, below_r + r
    return best[1]


def judge(pages, rules=RULES, context=CONTEXT, id_col="page_id", url_col="url"):
    """``page_id, host, path, rule, verdict`` of every row.

    The longest rule that fits decides. URLs that rules decide teach two character models, all of them counted but one in
    ``HELD_OUT``, on which the threshold is calibrated. Where no rule fits the models decide: allowed at or above the
    threshold. NULL URLs and those without ``://`` have an empty host and path and go to the models as an empty text.
    Repeated rows and NULL ids stay; extra columns are left out; an empty table gives an empty table.
    """
    host, path = parts(F.col("url"))
    split = bare(pages, page_id=id_col, url=url_col).select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = ruled(F.col("host"), F.col("path"), rules)
    marked = settle(split.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("says"), F.concat("host", "path").alias("text"),
                                 F.unhex(F.sha2(F.concat("host", "path"), 256)).alias("key")), "urls")
    held = F.conv(F.substring(F.md5("text"), 1, 4), 16, 10).cast("int") % HELD_OUT == 0
    texts = settle(marked.groupBy("key", "says").agg(F.any_value("text").alias("text"), F.count("*").alias("n")).withColumn("held", held), "texts")
    examples = texts.where("says is not null").select("key", "text", (F.col("says") == "allow").alias("accepted"), "n", "held")
    model = settle(contexts(examples.where(~F.col("held")), context), "contexts")
    # a text is ruled in one way, so its key stands in one row; written, so that the key is at hand before grams are made
    asked = settle(texts.where("says is null or held").select("key", "text"), "asked")
    scores = settle(differences(asked, model, context).select("key", F.floor(F.col("score") * BINS).cast("bigint").alias("bin")), "scores")
    limit = calibrate(examples.where("held").join(scores, "key").select("bin", "accepted", "n"))
    chosen = F.coalesce("says", F.when(F.col("bin") >= limit, "allow").otherwise("block"))
    return marked.join(scores, "key", "left").select("page_id", "host", "path", "rule", chosen.alias("verdict"))
