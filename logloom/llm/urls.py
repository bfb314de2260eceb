"""URL filter: rules on host and path, and a logistic regression on hashed
character n-grams of host and path trained from a small labelled table.

Host, path and rules are Spark columns; the model's weights, whose number is
``buckets``, score batches of URLs in tasks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_rows

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: (host, path, verdict); a rule fits its host and all subdomains.
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
PATHS = ("/en/98", "/es/7.html", "/de/65/", "/fr/4")
#: Paths that tell by themselves, on hosts that do not.
NEUTRAL_HOSTS = ("www.town-hall.example.com", "pages.rivers.example.net", "home.choir.example.org", "example.com")
UNWANTED_PATHS = (
    "/casino/slots.html", "/online-casino/poker", "/viagra", "/buy-viagra-online.html", "/cheap-pills/order", "/pills/buy-now", "/free-bets/bonus",
    "/xxx/videos/7", "/adult/chat", "/lottery/jackpot-win", "/payday-loans/apply", "/replica-watches/sale", "/crypto-doubler/claim", "/spam/links",
)
WANTED_PATHS = (
    "/articles/history-of-rome", "/docs/install.html", "/recipes/soup", "/wiki/Mathematics", "/news/2023/05/election", "/contact", "/about-us",
    "/courses/biology/plants", "/library/catalogue", "/", "/blog/2021/garden", "/music/concerts.html", "/museum/opening-hours", "/buy/tickets",
)
#: The small labelled table: (host, path, unwanted).
LABELLED = tuple(
    [(h, p, 1) for h in (
        "cheap-pills.example.com", "www.cheap-pills.example.net", "buy-cheap-pills-online.example.org", "m.discount-pills.example.com",
        "free-bets.example.com", "www.free-bets.example.org", "m.best-free-bets.example.net", "blog.sport-bets.example.com",
        "adult-x.example.com", "www.adult-x.example.net", "m.adult-video-x.example.org", "blog.adult-chat.example.com",
        "spam-farm.example.org", "www.spam-farm.example.com", "m.link-farm-spam.example.net", "blog.spam-links.example.com",
        "casino-bonus.example.com", "www.online-casino.example.net", "m.poker-bonus.example.org", "xxx-videos.example.com",
        "replica-watches.example.net", "fast-loan-cash.example.com", "www.payday-loan.example.org", "viagra-cheap.example.net",
        "casino-win.example.org", "www.win-casino.example.com", "ads-track.example.org", "m.ads-tracker.example.net", "track-ads.example.com",
    ) for p in PATHS]
    + [(h, p, 0) for h in (
        "www.theater.example.com", "blog.thinking.example.net", "m.nation.example.org", "therin.example.com", "www.library.example.org",
        "blog.gardens.example.com", "weather.example.net", "m.history.example.com", "science.example.org", "www.museum.example.net",
        "blog.cooking.example.org", "travel.example.com", "m.music.example.net", "www.school.example.com", "docs.software.example.org",
        "forum.bicycles.example.net", "news.example.com", "www.hospital.example.org", "wiki.mathematics.example.net", "m.reader.example.com",
        "blog.enerth.example.com", "www.ondthe.example.org", "thetion.example.net", "m.inghand.example.org", "www.example.com", "example.org",
        "blog.lesteau.example.net", "www.derung.example.com", "m.losado.example.org", "houwhere.example.com",
    ) for p in PATHS]
    + [(h, p, 1) for h in NEUTRAL_HOSTS for p in UNWANTED_PATHS]
    + [(h, p, 0) for h in NEUTRAL_HOSTS for p in WANTED_PATHS]
    + [("", "", 0)] * 8  # nothing to judge
)


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://`` or url."""
    return F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), UPPER, LOWER)


def path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://`` or url."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def rule_for(host_: Column, path_: Column, rules=RULES) -> Column:
    """(rule, verdict) of the longest rule that fits, as a struct; null if none does."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for h, p, verdict in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host_ == h) | host_.endswith("." + h)) & path_.startswith(p)
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def grams(host_: str, path_: str, buckets: int, sizes=(3, 4, 5)) -> np.ndarray:
    """Distinct hash buckets of the character n-grams of ^host$ and of ^path$, kept apart."""
    out = set()
    for kind, text in (("h", f"^{host_}$"), ("p", f"^{path_}$")):
        if len(text) > 2:
            for n in sizes:
                out.update(xxhash.xxh3_64_intdigest(f"{kind}{text[i : i + n]}") % buckets for i in range(len(text) - n + 1))
    return np.fromiter(out, np.int64, len(out))


def train(labelled=LABELLED, *, buckets: int = 1 << 16, epochs: int = 300, rate: float = 0.5, decay: float = 1e-3,
          max_labelled: int = 20_000) -> tuple[np.ndarray, float]:
    """Weights and intercept by gradient descent on at most max_labelled rows
    (host, path, 0 or 1). Both labels weigh the same. No rows give zeros."""
    rows = list(labelled)[:max_labelled]
    weights, bias = np.zeros(buckets), 0.0
    if not rows:
        return weights, bias
    found = [grams(h, p, buckets) for h, p, _ in rows]
    owner, at = np.repeat(np.arange(len(rows)), [len(g) for g in found]), np.concatenate(found)
    scale = 1 / np.sqrt(np.maximum(1, np.bincount(owner, minlength=len(rows))))
    y = np.array([label for _, _, label in rows], float)
    share = np.where(y > 0, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum()))
    for _ in range(epochs):
        z = bias + scale * np.bincount(owner, weights[at], len(rows))
        error = share * (1 / (1 + np.exp(-z)) - y) * len(rows) / 10
        weights -= rate * (np.bincount(at, (error * scale)[owner], buckets) + decay * weights)
        bias -= rate * error.sum() / 10
    return weights, float(bias)


def judge(pages: DataFrame, model: tuple[np.ndarray, float], id_col: str = "page_id", url_col: str = "url", *, rules=RULES,
          threshold: float = 0.5) -> DataFrame:
    """One row (page_id, host, path, rule, verdict, score) for each row of pages:
    the verdict of the longest rule that fits, else the model's: block at a
    score of threshold or more. Null urls and those without ``://`` have empty
    host and path and get what the intercept alone says. Repeated rows agree; an
    empty table gives no rows; other columns are not read."""
    weights, bias = model
    url = F.col(f"`{url_col}`").cast("string")
    parts = pages.select(F.col(f"`{id_col}`").alias("page_id"), host(url).alias("host"), path(url).alias("path"))
    id_type = parts.schema["page_id"].dataType.simpleString()

    def make():
        seen: dict[tuple[str, str], float] = {}

        def score(h: str, p: str) -> float:
            if len(seen) > 1 << 18:
                seen.clear()
            if (h, p) not in seen:
                g = grams(h, p, len(weights))
                z = bias + weights[g].sum() / max(1, len(g)) ** 0.5
                seen[h, p] = float(1 / (1 + np.exp(-z)))
            return seen[h, p]

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            scores = [score(h, p) for h, p in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            return pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], names=[*batch.schema.names, "score"])

        return step

    scored = map_rows(parts, make, f"page_id {id_type}, host string, path string, score double")
    rule = rule_for(F.col("host"), F.col("path"), rules)
    model_says = F.when(F.col("score") >= threshold, F.lit("block")).otherwise(F.lit("allow"))
    return scored.withColumn("_r", rule).select(
        "page_id", "host", "path", F.col("_r.rule").alias("rule"), F.coalesce("_r.verdict", model_says).alias("verdict"), "score")
