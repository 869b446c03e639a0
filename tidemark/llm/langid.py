"""Language of texts and pages by Bayesian fusion of evidence.

Evidence: the text's likelihood under byte 4-gram models of each language, the language the markup declares, the address's
suffix and path, and a prior of the host. How often a declaration or suffix goes with a language, and the languages of
a host, are grouped aggregates over all rows, weighted with the text's own posteriors; hosts are smoothed towards
their registered domain and domains towards all rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import textbytes as tb
from tidemark.session import materialize

#: Labelled documents of each language the text models are fitted on, at most, and languages told apart; more raise an error.
TRAIN_DOCS, MOST_LANGUAGES = 1_000, 200
#: Slots of the hashed 4-grams, share of unseen ones, and grams of a text that count as independent.
SLOTS, ADDED, INDEPENDENT = 1 << 18, 0.5, 60.0
#: Strength of the smoothing: of declarations and suffixes, of domains towards all, of hosts towards domains.
EVIDENCE_STRENGTH, DOMAIN_STRENGTH, HOST_STRENGTH = 5.0, 50.0, 50.0
FOLDS, HELD_OUT = 5, 0

_MARKUP = re.compile(r"<(script|style)\b.*?(?:</\1[^>]*>|\Z)|<!--.*?(?:-->|\Z)|<[a-zA-Z/!?][^>]*(?:>|\Z)|&#?\w+;", re.S | re.I)
_DECLARED = r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([a-zA-Z]{2,3})"
#: What is left out before the declaration is looked for; possessive, so that long ones need no stack.
_UNSEEN = r"(?is)<(script|style)\b(?:[^<]++|<(?!/\1))*+(?:</\1[^>]*+>?|\z)|<!--(?:-?>|(?:[^-]++|-(?!-!?>))*+(?:--!?>|\z))"


def _slots(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and slot of every 4-gram of bytes; ASCII letters in small, digits and ASCII marks as blanks."""
    plain = _PLAIN[raw].astype(np.uint32)
    if len(plain) < 4:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    code = plain[:-3] | (plain[1:-2] << np.uint32(8)) | (plain[2:-1] << np.uint32(16)) | (plain[3:] << np.uint32(24))
    rows = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    inside = (rows[:-3] == rows[3:]) & (code != 0x20202020)
    slot = (code * np.uint32(0x9E3779B1)) >> np.uint32(14)
    return rows[:-3][inside], slot[inside].astype(np.int64)


_PLAIN = np.full(256, 32, np.uint8)
_PLAIN[97:123] = np.arange(97, 123)
_PLAIN[65:91] = np.arange(97, 123)
_PLAIN[128:] = np.arange(128, 256)


def _gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        labels = batch.column(1).to_pylist()
        for first, _, raw, offsets in tb.pieces(batch.column(0)):
            rows, slots = _slots(raw, offsets)
            for label in sorted(set(labels[first : first + len(offsets) - 1])):
                own = np.array([x == label for x in labels[first : first + len(offsets) - 1]])
                counts = np.bincount(slots[own[rows]], minlength=SLOTS)
                at = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays([pa.array([label] * len(at), pa.string()), pa.array(at), pa.array(counts[at])], names=["lang", "slot", "n"])


def train(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages and log-shares (language, slot) from the labelled rows of ``docs`` (doc_id, text, lang) outside fold 0.

    At most ``TRAIN_DOCS`` of each language are read, those with the least hash of doc_id, and ``MOST_LANGUAGES`` languages.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS
    rows = rows.where("doc_id IS NOT NULL AND lang IS NOT NULL AND text IS NOT NULL").where(fold != HELD_OUT)
    langs = [r.lang for r in rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MOST_LANGUAGES + 1).collect()]
    if len(langs) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    chosen = None
    for lang in langs:
        part = rows.select("doc_id", "lang").where(F.col("lang") == lang).orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAIN_DOCS)
        chosen = part if chosen is None else chosen.unionByName(part)
    if chosen is None:
        return [], np.zeros((0, SLOTS), np.float32)
    texts = rows.join(chosen.select("doc_id").distinct(), "doc_id", "left_semi").select("text", "lang")
    table = texts.mapInArrow(_gram_counts, "lang string, slot long, n long").groupBy("lang", "slot").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros((len(langs), SLOTS))
    at = np.array([langs.index(x) for x in table.column("lang").to_pylist()], np.int64)
    counts[at, table.column("slot").to_numpy()] = table.column("n").to_numpy()
    shares = (counts + ADDED) / (counts.sum(axis=1, keepdims=True) + ADDED * SLOTS)
    return langs, np.log(shares).astype(np.float32)


def _text_logs(shared, n_langs: int, markup: bool):
    """The text column replaced by an array of log-likelihoods, of at most ``INDEPENDENT`` grams' weight."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                parts = [np.zeros((0, n_langs))]
                texts = batch.column(0)
                if markup:
                    texts = pa.array([_MARKUP.sub(" ", t) if t else "" for t in texts.to_pylist()], pa.string())
                for _, _, raw, offsets in tb.pieces(texts):
                    rows, slots = _slots(raw, offsets)
                    n = len(offsets) - 1
                    grams = np.bincount(rows, minlength=n)
                    logs = np.stack([np.bincount(rows, one[slots], n) for one in table], axis=1)
                    parts.append(logs * (np.minimum(grams, INDEPENDENT) / np.maximum(grams, 1))[:, None])
                logs = np.concatenate(parts)
                logs = logs - logs.max(axis=1, keepdims=True, initial=-np.inf)
                found = pa.ListArray.from_arrays(np.arange(len(logs) + 1, dtype=np.int32) * n_langs, pa.array(logs.reshape(-1)))
                yield pa.RecordBatch.from_arrays([found, *(batch.column(i) for i in range(1, batch.num_columns))], names=["logs", *batch.schema.names[1:]])

    return run


def _posterior(logs):
    """Probabilities of an array of log-weights."""
    top = F.array_max(logs)
    raised = F.transform(logs, lambda x: F.exp(x - top))
    return F.transform(raised, lambda x: x / F.aggregate(raised, F.lit(0.0), lambda a, b: a + b))


def _sums(df: DataFrame, keys: list[str], n: int) -> DataFrame:
    """Expected number of rows of each language by ``keys``, as an array: partial sums, so a hot key is no single task."""
    return df.groupBy(*keys).agg(F.array(*(F.sum(F.col("p")[i]) for i in range(n))).alias("mass"))


def _shares(mass, base, strength: float):
    """Counts smoothed towards ``base``."""
    total = F.aggregate(mass, F.lit(0.0), lambda a, b: a + b)
    return F.zip_with(mass, base, lambda m, b: (m + F.lit(strength) * b) / (total + F.lit(strength)))


def _address(url):
    """Host, registered domain, and suffix: the last part of the host and the path's leading language-like part."""
    host = F.lower(F.regexp_extract(url, r"^[a-zA-Z][\w+.-]*://(?:[^/@?#]*@)?([^/:?#]*)", 1))
    domain = F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1)
    top = F.regexp_extract(host, r"\.([^.]+)$", 1)
    lead = F.lower(F.regexp_extract(url, r"://[^/]*/([a-zA-Z]{2})(?:[/?#]|$)", 1))
    blank = lambda c: F.when(F.length(c) > 0, c)
    return blank(host), F.coalesce(blank(domain), blank(host)), F.when((F.length(top) > 0) | (F.length(lead) > 0), F.concat_ws("/", top, lead))


def identify(rows: DataFrame, docs: DataFrame, markup: bool = False) -> DataFrame:
    """``rows`` (key, text, declared, host, domain, suffix) with lang, posterior and text_lang instead of text.

    ``docs`` (doc_id, text, lang) teaches the text models. Whole texts are read; ``markup`` drops tags first.
    Evidence that is NULL says nothing, and a row without any gets the prior of all rows. Without a labelled
    document every language is NULL. Ties go to the language with more labelled documents.
    """
    langs, table = train(docs)
    n = len(langs)
    keys = [c for c in rows.columns if c != "text"]
    if not n:
        return rows.select(*keys, F.lit(None).cast("string").alias("lang"), F.lit(None).cast("double").alias("posterior"), F.lit(None).cast("string").alias("text_lang"))
    shared = rows.sparkSession.sparkContext.broadcast(table)
    kept = rows.select("text", *keys)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[1:])
    seen = kept.mapInArrow(_text_logs(shared, n, markup), f"logs array<double>, {kinds}")
    seen = materialize(seen.withColumn("p", _posterior(F.col("logs"))), "text-evidence")

    everything = seen.agg(*(F.sum(F.col("p")[i]) for i in range(n))).first()
    total = sum(x or 0.0 for x in everything) or 1.0
    prior = [((x or 0.0) + 0.5) / (total + 0.5 * n) for x in everything]
    base = F.array(*(F.lit(x) for x in prior))
    # the likelihood of a value under each language, over the value's overall share: p(language | value) / p(language)
    for name in ("declared", "suffix"):
        ratio = _sums(seen.where(F.col(name).isNotNull()), [name], n)
        ratio = ratio.select(F.col(name), F.zip_with(_shares(F.col("mass"), base, EVIDENCE_STRENGTH), base, lambda s, b: F.log(s / b)).alias(f"{name}_logs"))
        seen = seen.join(ratio, name, "left")
    domains = _sums(seen.where("domain IS NOT NULL"), ["domain"], n).select("domain", _shares(F.col("mass"), base, DOMAIN_STRENGTH).alias("domain_shares"))
    hosts = _sums(seen.where("host IS NOT NULL AND domain IS NOT NULL"), ["host", "domain"], n).join(domains, "domain")
    hosts = hosts.select("host", "domain", F.transform(_shares(F.col("mass"), F.col("domain_shares"), HOST_STRENGTH), lambda s: F.log(s)).alias("prior_logs"))
    joined = seen.join(hosts, ["host", "domain"], "left")

    none = F.array(*(F.lit(0.0) for _ in langs))
    add = lambda a, b: F.zip_with(a, b, lambda x, y: x + y)
    fused = F.coalesce("prior_logs", F.array(*(F.lit(float(np.log(x))) for x in prior)))
    for part in ("logs", "declared_logs", "suffix_logs"):
        fused = add(fused, F.coalesce(part, none))
    names = F.array(*(F.lit(x) for x in langs))
    best = lambda p: F.element_at(names, F.array_position(p, F.array_max(p)).cast("int"))
    result = joined.withColumn("fused", _posterior(fused))
    return result.select(*keys, best(F.col("fused")).alias("lang"), F.array_max("fused").alias("posterior"), best(F.col("p")).alias("text_lang"))


def identify_pages(pages: DataFrame, docs: DataFrame) -> DataFrame:
    """(page_id, url, lang, posterior, text_lang, declared) of every row of ``pages`` (page_id, url, html).

    NULL html or url give no evidence of their kind; repeated rows each count and are answered; other columns are left out.
    """
    host, domain, suffix = _address(F.col("url").cast("string"))
    page = F.col("html").cast("string")
    declared = F.lower(F.regexp_extract(F.regexp_replace(page, _UNSEEN, " "), _DECLARED, 1))
    rows = pages.select(
        page.alias("text"), F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.when(F.length(declared) > 0, declared).alias("declared"), host.alias("host"), domain.alias("domain"), suffix.alias("suffix"),
    )
    return identify(rows, docs, markup=True).select("page_id", "url", "lang", "posterior", "text_lang", "declared")


def identify_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, posterior, text_lang) of every row of ``docs``: the text, with the source as host."""
    source = F.col("source").cast("string")
    nothing = F.lit(None).cast("string")
    rows = docs.select(
        F.col("text").cast("string").alias("text"), F.col("doc_id").cast("long").alias("doc_id"),
        nothing.alias("declared"), source.alias("host"), F.when(source.isNotNull(), F.lit("documents")).alias("domain"), nothing.alias("suffix"),
    )
    return identify(rows, docs).select("doc_id", "lang", "posterior", "text_lang")
