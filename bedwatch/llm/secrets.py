"""Secret scan with corpus-wide ownership: values copied by many owners, repositories or rows are examples, others look live.

DataFrame functions only. Spark has no function that tells where matches of a pattern are, but splitting a text at
the pattern and extracting all matches walk over the same matches in the same order; the lengths of the pieces in
between give every start.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from bedwatch.llm.common import stage, whole_text


class Kind(NamedTuple):
    name: str
    pattern: str  # group 0 is the span
    secret: int  # group that is the secret itself
    least: int  # characters it has at least
    base: bool = False


# ---- Fixed values: the kinds of the contract, in its order, then those of this method. ----
KINDS = (
    Kind("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         2, 12, True),
    Kind("access", r"AKIA[A-Z0-9]+", 0, 18, True),
    Kind("hex", r"[0-9a-f]{16,}", 0, 16, True),
    Kind("github", r"gh[pousr]_[A-Za-z0-9]+", 0, 24),
    Kind("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 30),
    Kind("slack", r"xox[abprs]-[A-Za-z0-9-]+", 0, 20),
    Kind("private_key", r"""-----BEGIN [A-Z ]*PRIVATE KEY-----(?:(?:\s*Proc-Type:[^\n]*\s+DEK-Info:[^\n]*)?[A-Za-z0-9+/=\s\\]*+"""
         r"""-----END [A-Z ]*PRIVATE KEY-----)?""", 0, 27),  # to its end; a header alone where there is none
)


_SPANS = "array<struct<start:int,rank:int,stop:int,kind:string,secret:string>>"


def spans_of(kind: Kind, rank: int) -> Column:
    """The kind's leftmost non-overlapping matches that are long enough: array of (start, rank, stop, kind, secret)."""
    text, pattern = F.col("text"), F.lit(kind.pattern)
    hits = F.regexp_extract_all(text, pattern, F.lit(0))
    words = F.regexp_extract_all(text, pattern, F.lit(kind.secret)) if kind.secret else hits
    gaps = F.transform(F.split(text, kind.pattern, -1), lambda p: F.length(p))  # one more than there are matches
    matches = F.zip_with(
        F.zip_with(F.slice(gaps, F.lit(1), F.size(hits)), hits, lambda gap, hit: F.struct(
            gap.alias("gap"), F.length(hit).alias("size"))),
        words, lambda m, word: F.struct(m["gap"].alias("gap"), m["size"].alias("size"), word.alias("word")))

    def step(acc, m):
        start = acc["at"] + m["gap"]
        span = F.struct(start.alias("start"), F.lit(rank).alias("rank"), (start + m["size"]).alias("stop"),
                        F.lit(kind.name).alias("kind"), m["word"].alias("secret"))
        return F.struct((start + m["size"]).alias("at"), F.when(
            F.length(m["word"]) >= kind.least, F.array_append(acc["out"], span)).otherwise(acc["out"]).alias("out"))

    begin = F.struct(F.lit(0).alias("at"), F.array().cast(_SPANS).alias("out"))
    found = F.aggregate(matches, begin, step, lambda acc: acc["out"])
    return F.when(text.rlike(kind.pattern), found).otherwise(F.array().cast(_SPANS))


def find_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", repo: Column | None = None,
               owner: Column | None = None, kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """(doc_id, text_hash, repo, owner, spans): every row's spans by start, then kind as listed. Null texts have none.

    A span is (start, rank, stop, kind, size, hash): the secret itself, the last ``size`` characters of the span, is
    hashed and never written anywhere.
    """
    text = whole_text(text_col)
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), (F.lit(None) if repo is None else repo).cast("string").alias("repo"),
        (F.lit(None) if owner is None else owner).cast("string").alias("owner"), text.alias("text"))
    rows = rows.select("doc_id", "text_hash", "repo", "owner",
                       *[spans_of(k, i).alias(f"k{i}") for i, k in enumerate(kinds)])
    found = F.array_sort(F.concat(*[f"k{i}" for i in range(len(kinds))]))
    return rows.select("doc_id", "text_hash", "repo", "owner", F.transform(found, lambda s: F.struct(
        s["start"].alias("start"), s["rank"].alias("rank"), s["stop"].alias("stop"), s["kind"].alias("kind"),
        F.length(s["secret"]).alias("size"), F.sha2(s["secret"], 256).alias("hash"))).alias("spans"))


def ownership(spans: DataFrame) -> DataFrame:
    """(kind, hash, owners, repos, places): how many distinct owners, repositories and rows hold each secret.

    Rows are first counted per secret, owner and repository, which Spark combines before the shuffle, so a value
    that fills a third of the corpus is a few rows by then. Unknown owners or repositories count as one each.
    """
    held = spans.select("owner", "repo", F.explode(F.array_distinct(F.transform(
        "spans", lambda s: F.struct(s["kind"].alias("kind"), s["hash"].alias("hash"))))).alias("s")).select(
        "owner", "repo", "s.kind", "s.hash")
    each = held.groupBy("kind", "hash", "owner", "repo").agg(F.count("*").alias("places"))
    by_owner = each.groupBy("kind", "hash", "owner").agg(F.sum("places").alias("places"), F.count("*").alias("repos"))
    return by_owner.groupBy("kind", "hash").agg(
        F.count("*").alias("owners"), F.sum("repos").alias("repos"), F.sum("places").alias("places"))


def _is_live(owners: int, repos: int, places: int) -> Column:
    return (F.col("owners") < owners) & (F.col("repos") < repos) & (F.col("places") < places)


def _listed(spans: str, bases: bool = False) -> Column:
    kept = F.filter(spans, lambda s: s.rank < sum(k.base for k in KINDS)) if bases else F.col(spans)
    return F.concat_ws(",", F.transform(kept, lambda s: F.concat_ws(
        ":", s.kind, s.start.cast("string"), s.stop.cast("string"))))


def scan_secrets(docs: DataFrame, repo: Column | None = None, owner: Column | None = None,
                 example_owners: int = 3, id_col: str = "doc_id", text_col: str = "text", example_repos: int = 5,
                 example_places: int = 1000) -> DataFrame:
    """One row per row of ``docs``: its spans, each with a verdict from the whole corpus.

    A secret held by ``example_owners`` distinct owners, ``example_repos`` repositories or ``example_places`` rows, or
    more, is an ``example`` (copied from documentation or a template); one below all three is ``live``. Columns: row, doc_id, text_hash, repo, owner, spans (start, rank,
    stop, kind, size, hash), verdicts (start, rank, stop, kind, live, owners, repos, places). Null texts and texts without secrets have empty arrays; repeated rows
    come out repeated; a null doc_id stays null.
    """
    found = stage(find_spans(docs, id_col, text_col, repo, owner).withColumn(
        "row", F.monotonically_increasing_id()), "secret-spans")  # written, so the row numbers stay as they are
    known = ownership(found.filter(F.size("spans") > 0))
    hits = found.filter(F.size("spans") > 0).select("row", F.explode("spans").alias("s"))
    hits = hits.select("row", "s", "s.kind", "s.hash")
    judged = hits.join(known, ["kind", "hash"]).groupBy("row").agg(F.sort_array(F.collect_list(F.struct(
        "s.start", "s.rank", "s.stop", "s.kind", _is_live(example_owners, example_repos, example_places).alias("live"),
        "owners", "repos", "places")))
        .alias("verdicts"))
    none = F.expr("cast(array() as array<struct<start:int,rank:int,stop:int,kind:string,live:boolean,"
                  "owners:bigint,repos:bigint,places:bigint>>)")
    return found.join(judged, "row", "left").withColumn("verdicts", F.coalesce("verdicts", none))


def digest(scanned: DataFrame) -> DataFrame:
    """The columns of the contract, how many spans look live or copied, and each span's owners, repositories and rows."""
    def count(kind):
        return F.size(F.filter("spans", lambda s: s.kind == kind)).cast("long")

    return scanned.select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(_listed("spans", True), 256).alias("base_sha256"), _listed("spans").alias("spans"),
        F.size(F.filter("verdicts", lambda v: v.live)).cast("long").alias("n_live"),
        F.size(F.filter("verdicts", lambda v: ~v.live)).cast("long").alias("n_example"),
        F.concat_ws(",", F.transform("verdicts", lambda v: F.concat_ws(":", v.kind, *[
            v[c].cast("string") for c in ("start", "stop", "owners", "repos", "places")]))).alias("frequency"))


def redact(docs: DataFrame, repo: Column | None = None, owner: Column | None = None,
           example_owners: int = 3, mark: str = "<secret>", example_repos: int = 5,
           example_places: int = 1000) -> DataFrame:
    """``docs`` with every secret that looks live (as in ``scan_secrets``) replaced by ``mark``; no row is dropped, other columns stay.

    The secret's value is replaced wherever it stands in a text, so copies of a row need no row number, and values
    of examples stay. Texts without live secrets (null ones too) are unchanged; n_chars is set anew where the
    text changes.
    """
    found = stage(find_spans(docs, repo=repo, owner=owner).filter(F.size("spans") > 0), "secret-spans")
    live = ownership(found).filter(_is_live(example_owners, example_repos, example_places)).select("kind", "hash")
    hits = found.select("doc_id", "text_hash", F.explode("spans").alias("s")).select(
        "doc_id", "text_hash", "s.kind", "s.hash", "s.stop", "s.size")
    # rows equal in id and text share the list, so it is as long as the text has secrets
    lists = hits.join(live, ["kind", "hash"]).groupBy("doc_id", "text_hash").agg(
        F.collect_set(F.struct("stop", "size")).alias("__at")).select(
        F.col("doc_id").alias("__id"), F.col("text_hash").alias("__text"), "__at")
    joined = docs.join(lists, F.col("doc_id").cast("long").eqNullSafe(F.col("__id"))
                       & (F.xxhash64(whole_text()) == F.col("__text")), "left")
    words = F.array_distinct(F.transform("__at", lambda s: F.substring(
        F.col("text"), s["stop"] - s["size"] + 1, s["size"])))
    joined = joined.withColumn("__words", F.array_sort(
        words, lambda a, b: F.when(F.length(a) != F.length(b), F.length(b) - F.length(a))
        .when(a < b, -1).when(a > b, 1).otherwise(0)))
    clean = F.when(F.col("__words").isNull(), F.col("text")).otherwise(F.aggregate(
        "__words", F.col("text"), lambda t, w: F.replace(t, w, F.lit(mark))))
    changed = F.col("__words").isNotNull() & F.col("text").isNotNull()
    columns = [F.when(changed, F.length("__clean").cast(docs.schema[c].dataType)).otherwise(F.col(c)).alias(c)
               if c == "n_chars" else F.col("__clean").alias(c) if c == "text" else F.col(c) for c in docs.columns]
    return joined.withColumn("__clean", clean).select(columns)
