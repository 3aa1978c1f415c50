"""Language identification by fusing evidence after Bayes.

Four pieces of evidence meet per text: the likelihood of its letter trigrams under each language, the language
that its source declares (a column, or the ``lang`` of its markup), the suffix of its address, and a prior from
its host. The prior is smoothed over a hierarchy: a host's share of each language is drawn towards that of the
domain above it and the domain's towards that of all rows; a row's own share is taken out of its host's and
domain's first, so that no text speaks twice. Shares and suffixes are sums over all rows, grouped by host, domain
and suffix; a host with a third of the rows is added up in parts and the small rows it is joined back to are
split by Spark if they are skewed.

``other`` is one more language, in which all trigrams are equally likely. A text is identified if some language
but ``other`` has at least ``SURE`` of the posterior; it is then kept.

Trigrams are learned from at most ``SAMPLE`` rows with a declared language, those with the smallest hash of
their id. Texts are scored whole; overlapping trigrams are no independent witnesses, so a text's mean is
weighed as at most ``WITNESSES`` of them.

Rows: a NULL or empty text, or one without letters, has no text evidence and is never kept; its posterior is
that of the other evidence. An unknown or NULL declaration, address or host is no evidence. Repeated rows count
each. Without any declared row all languages have equal likelihoods. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import bounded_sample, written
from tidemark.llm.url_trust import host_of

LANGUAGES = ("en", "fr", "de", "es")
OTHER = "other"
SAMPLE = 4_000
BUCKET_BITS = 14
SMOOTHING = 0.05
WITNESSES = 40
# How often a declaration is right, and the prior of a text in none of the languages.
DECLARED_RIGHT = 0.8
OTHER_PRIOR = 0.01
# Rows' worth of pull from the level above.
HOST_PULL, DOMAIN_PULL = 20.0, 50.0
SURE = 0.5
# Letters are looked up below this code point; all beyond count as letters.
TABLED = 0x3000
PIECE = 1 << 20

_A, _B, _C = np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D)


def trigrams(text: bytes | None) -> np.ndarray:
    """Bucket of every trigram around a letter, lower-cased."""
    codes = np.frombuffer((text or b"").decode("utf-8", "replace").lower().encode("utf-32-le"), np.uint32)
    if len(codes) < 3:
        return np.zeros(0, np.int64)
    letters = _LETTERS[np.minimum(codes, TABLED - 1)] | (codes >= TABLED)
    codes = np.where(letters, codes, np.uint32(32))
    with np.errstate(over="ignore"):
        hashes = codes[:-2] * _A + codes[1:-1] * _B + codes[2:] * _C
    hashes ^= hashes >> np.uint32(15)
    return ((hashes * _A) >> np.uint32(32 - BUCKET_BITS))[letters[1:-1]].astype(np.int64)


_LETTERS = np.array([chr(c).isalpha() for c in range(TABLED)])


def pieces(text: bytes, size: int = PIECE) -> Iterator[bytes]:
    """A long text in parts of about ``size`` bytes, whole characters each. Two characters overlap, so every three
    that follow one another are in one part, and in one only."""
    start = 0
    while True:
        end = min(len(text), start + size)
        while end < len(text) and text[end] & 0xC0 == 0x80:
            end += 1
        yield text[start:end]
        if end == len(text):
            return
        start = end
        for _ in range(2):
            start -= 1
            while start > 0 and text[start] & 0xC0 == 0x80:
                start -= 1


def learn(rows: DataFrame, languages: tuple[str, ...]) -> np.ndarray:
    """Log likelihoods, one row per bucket and a column per language and for ``other``.

    ``rows`` has text (bytes) and declared.
    """

    def work(batches):
        counts = np.zeros((len(languages), 1 << BUCKET_BITS), np.int64)
        for frame in batches:
            for text, declared in zip(frame["text"], frame["declared"]):
                counts[languages.index(declared)] += np.bincount(trigrams(text), minlength=1 << BUCKET_BITS)
        yield pd.DataFrame({"language": range(len(languages)), "counts": list(counts)})

    counts = np.zeros((1 << BUCKET_BITS, len(languages) + 1))
    for part in rows.mapInPandas(work, "language int, counts array<long>").toLocalIterator():
        counts[:, part["language"]] += np.array(part["counts"])
    counts += SMOOTHING
    counts[:, -1] = 1
    return np.log(counts / counts.sum(axis=0)).astype(np.float32)


def softmax(logs: np.ndarray) -> np.ndarray:
    parts = np.exp(logs - logs.max(axis=1, keepdims=True))
    return parts / parts.sum(axis=1, keepdims=True)


def witness(table: np.ndarray, languages: tuple[str, ...]):
    """A pandas UDF over text bytes and declaration.

    Per language the log evidence of both, what share of the row each language so gets, and if there are letters.
    """
    said = np.log((1 - DECLARED_RIGHT) / len(languages))

    @F.pandas_udf("logs array<double>, shares array<double>, letters boolean")
    def judge(texts: pd.Series, declared: pd.Series) -> pd.DataFrame:
        logs, letters = np.zeros((len(texts), table.shape[1])), np.zeros(len(texts), bool)
        for row, (text, name) in enumerate(zip(texts, declared)):
            n = 0
            for piece in pieces(text or b""):
                found = trigrams(piece)
                logs[row] += table[found].sum(axis=0, dtype=np.float64)
                n += len(found)
            logs[row] *= min(n, WITNESSES) / max(n, 1)
            letters[row] = n > 0
            if name in languages:
                logs[row] += said
                logs[row, languages.index(name)] += np.log(DECLARED_RIGHT) - said
        return pd.DataFrame({"logs": list(logs), "shares": list(softmax(logs)), "letters": letters})

    return judge


def fusion(classes: list[str], whole: np.ndarray, suffixes: int):
    """A pandas UDF that adds priors and suffixes to the evidence of a row: language and posterior.

    ``whole`` are the shares of all rows, ``suffixes`` how many different ones there are. The host's, the domain's
    and the suffix's shares are those of all their rows, NULL without such a level; a row's own are taken out.
    """
    overall = np.append((whole[:-1] + 1) / (whole[:-1].sum() + len(whole) - 1) * (1 - OTHER_PRIOR), OTHER_PRIOR)

    def rest(level: pd.Series, own: np.ndarray) -> np.ndarray:
        missing = np.zeros(len(classes))
        return np.maximum(np.stack([missing if v is None else v for v in level]) - own, 0)

    @F.pandas_udf("language string, posterior double")
    def fuse(logs: pd.Series, shares: pd.Series, host: pd.Series, domain: pd.Series, suffix: pd.Series) -> pd.DataFrame:
        if logs.empty:
            return pd.DataFrame({"language": pd.Series([], dtype=str), "posterior": pd.Series([], dtype=float)})
        own, prior = np.stack(shares), overall
        for level, pull in ((rest(domain, own), DOMAIN_PULL), (rest(host, own), HOST_PULL)):
            prior = (level + pull * prior) / (level.sum(axis=1, keepdims=True) + pull)
        known = np.array([v is not None for v in suffix])
        told = np.log((rest(suffix, own) + 1) / (np.maximum(whole - own, 0) + max(suffixes, 1)))
        posterior = softmax(np.stack(logs) + np.log(prior) + np.where(known[:, None], told, 0.0))
        best = posterior.argmax(axis=1)
        return pd.DataFrame({"language": np.array(classes)[best], "posterior": posterior.max(axis=1)})

    return fuse


def markup_language(html: Column) -> Column:
    """The ``lang`` that the root element of a page declares, without its region; NULL if none.

    The root element is the first ``<html`` tag outside comments, wherever in the page it stands.
    """
    root = F.regexp_extract(F.regexp_replace(html, r"(?s)<!--.*?-->", " "), r"(?i)<html\b[^>]*", 0)
    named = F.regexp_extract(root, r"""(?i)\blang\s*=\s*["']?([a-z]+)""", 1)
    return F.nullif(F.lower(named), F.lit(""))


def suffix_of(host: Column) -> Column:
    """The last label of a host that has more than one."""
    return F.nullif(F.regexp_extract(host, r"\.([^.:]+)(?::\d+)?$", 1), F.lit(""))


def domain_of(host: Column) -> Column:
    """What stands after the first label; NULL for a host of one label."""
    return F.nullif(F.regexp_extract(host, r"^[^.]*\.(.+)$", 1), F.lit(""))


def web_evidence(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, text, declared, host) of web pages; markup is taken out of the text."""
    host = F.nullif(host_of(F.col(url_col)), F.lit(""))
    plain = F.regexp_replace(F.regexp_replace(html_col, r"(?is)<(script|style)\b.*?</\1\s*>", " "), r"<[^>]*>", " ")
    return pages.select(
        F.col(id_col).cast("long").alias("id"), plain.alias("text"), markup_language(F.col(html_col)).alias("declared"),
        host.alias("host"),
    )


def document_evidence(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source", also: tuple[str, ...] = ()) -> DataFrame:
    """(id, text, declared, host) of documents, whose source stands for the host, and the columns ``also`` names."""
    return docs.select(
        *also, F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), F.lower(lang_col).alias("declared"),
        F.col(source_col).alias("host"),
    )


def identify(evidence: DataFrame, keys: list[str], languages: tuple[str, ...] = LANGUAGES, sample_by: list[str] | None = None) -> DataFrame:
    """The key columns with language, posterior and kept, for every row.

    ``evidence`` has the keys, text, declared and host; the keys name a row. ``sample_by`` chooses the rows that
    teach, the keys if not given.
    """
    classes = [*languages, OTHER]
    chosen_by = sample_by or keys
    apart_from = [c for c in chosen_by if c not in (*keys, "text", "declared", "host")]
    read = evidence.select(*keys, *apart_from, F.col("text").cast("binary").alias("text"), "declared", "host")
    taught = bounded_sample(read.where(F.col("declared").isin(*languages)), *chosen_by, "declared", rows=SAMPLE)
    table = learn(taught.select("text", "declared"), languages)
    seen = witness(table, languages)(F.col("text"), F.col("declared")).alias("w")
    rows = written(read.select(*keys, "host", seen).select(*keys, "host", "w.*"), "evidence")

    def added(frame: DataFrame, name: str):
        return frame.agg(F.array(*[F.sum(F.col(name)[i]) for i in range(len(classes))]).alias("sums"))

    hosts = added(rows.where("host IS NOT NULL").groupBy("host"), "shares").withColumnRenamed("sums", "of_host")
    hosts = written(hosts.select("*", domain_of(F.col("host")).alias("domain"), suffix_of(F.col("host")).alias("suffix")), "hosts")
    # Domain and suffix follow from the host, so what is known of all three is one row per host.
    for level in ("domain", "suffix"):
        sums = added(hosts.where(F.col(level).isNotNull()).groupBy(level), "of_host")
        hosts = hosts.join(sums.withColumnRenamed("sums", f"of_{level}"), level, "left")
    whole = added(rows, "shares").first()["sums"]
    suffixes = hosts.agg(F.countDistinct("suffix")).first()[0]
    # Rows without a host meet nobody; spread out, they do not meet in one task either.
    apart = F.concat(F.lit("\0"), F.pmod(F.xxhash64(*keys), F.lit(4096)).cast("string"))
    joined = rows.withColumn("host", F.coalesce("host", apart)).join(hosts, "host", "left")
    fuse = fusion(classes, np.array([x or 0.0 for x in whole]), suffixes)
    fused = fuse(*[F.col(c) for c in ("logs", "shares", "of_host", "of_domain", "of_suffix")])
    judged = joined.select(*keys, "letters", fused.alias("f")).select(*keys, "letters", "f.*")
    kept = F.col("letters") & (F.col("language") != OTHER) & (F.col("posterior") >= SURE)
    return judged.select(*keys, "language", "posterior", kept.alias("kept"))
