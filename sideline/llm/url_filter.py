"""URL filters: a blocked Bloom filter of listed keys ahead of an exact hash join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sideline.llm.bloom import bloom_words, may_contain, words_for


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path; both empty for null and for a text without ://.

    The host starts after the first :// and ends before /, ? or #; the path goes on to ? or #.
    """
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"(?s)^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)


def judge(
    pages: DataFrame, listed: DataFrame, id_col: str = "page_id", url_col: str = "url",
    default: str = "allow",
) -> DataFrame:
    """Verdict of every page by the longest listed entry that fits its url.

    ``listed`` has host, path and verdict. An entry fits a url of its host or of a subdomain whose
    path starts with the entry's path; an entry with a whole url's host and path lists that url. The
    longest entry (host and path together) wins, then the longer host; of entries listed twice the
    smaller verdict counts. A url that no entry fits gets ``default``.

    1. A Bloom filter of the listed hosts passes the ends of a url's host that may be listed, from
       whole labels. Those meet the listed hosts, each with the lengths that its paths have.
    2. With each such length a key is formed: the host's end and the first so many characters of the
       path. A Bloom filter of the listed hosts and paths passes possible keys to an exact hash
       join on the key, which removes the false positives. So lists of any size and shape are
       taken, and a host with many entries and many pages never meets itself pair by pair.

    The filters reach the tasks as constants of bounded size (see ``bloom``); for longer lists more
    keys pass, and the joins still decide. Everything is built-in columns.

    Returns one row per page: id, host, path, rule (host and path of the entry, else null), verdict.
    Null urls and urls without :// have empty parts and get the default, unless an entry has an
    empty host. Other columns of ``pages`` are not read.
    """
    listed = listed.select(
        F.coalesce("host", F.lit("")).alias("r_host"), F.coalesce("path", F.lit("")).alias("r_path"), F.col("verdict").alias("r_verdict"),
    ).groupBy("r_host", "r_path").agg(F.min("r_verdict").alias("r_verdict"))
    listed = listed.withColumn("key", F.concat_ws("\x00", "r_host", "r_path"))
    host, path = url_parts(F.col(url_col))
    # by url, so that repeated pages are looked up once; a null url is a value of its own
    known = F.coalesce(F.concat(F.lit("="), F.col(url_col)), F.lit(""))
    urls = pages.select(F.col(id_col), known.alias("_url"), host.alias("host"), path.alias("path"))
    labels, count = listed.agg(F.max(F.size(F.split("r_host", r"\."))), F.count(F.lit(1))).first()
    none = [F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict")]
    if not count:
        return urls.select(id_col, "host", "path", *none)
    hosts = listed.groupBy("r_host").agg(F.sort_array(F.collect_set(F.length("r_path"))).alias("lengths"))
    words = words_for(count)
    # an end of the host from the k-th dot from the right on
    ends = f"transform(sequence(1, least({labels}, size(split(host, '[.]')))), k -> substring_index(host, '.', -k))"
    urls = urls.withColumn("_hosts", bloom_words(hosts, "r_host", words).scalar())
    urls = urls.withColumn("_ends", F.expr(f"filter({ends}, e -> {may_contain('_hosts', 'e', words)})")).drop("_hosts")
    possible = F.size("_ends") > 0
    asked = urls.filter(possible).select("_url", "path", F.explode("_ends").alias("r_host")).distinct()
    keys = asked.join(hosts, "r_host").select(
        "_url", F.expr("explode(transform(filter(lengths, n -> n <= length(path)), n -> concat_ws('\0', r_host, substring(path, 1, n)))) AS key"))
    keys = keys.withColumn("_words", bloom_words(listed, "key", words).scalar()).filter(may_contain("_words", "key", words)).drop("_words")
    found = keys.join(listed, "key").groupBy("_url").agg(F.max(F.struct(
        F.length(F.concat("r_host", "r_path")).alias("a"), F.length("r_host").alias("b"),
        F.concat("r_host", "r_path").alias("rule"), F.col("r_verdict").alias("verdict"))).alias("best"))
    judged = urls.filter(possible).select(id_col, "_url", "host", "path").join(found, "_url", "left")
    judged = judged.select(id_col, "host", "path", "best.rule", F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
    return judged.unionByName(urls.filter(~possible).select(id_col, "host", "path", *none))
