"""Catalog search: strategies (A8), blocked candidates (J1), ranking.

The original tool sends each strategy string to a remote search engine and
reads the first page (10 results).  Here the engine is a join against the
catalog with a stated semantics.  With words(x) the distinct words of
normalize(x), a catalog entry matches a strategy s when

* s is plain: Jaccard(words(s), words(title)) >= 1/2, i.e.
  3 * |shared| >= |words(s)| + |words(title)|;
* s looks like an acronym (2-10 letters A-Z after upper-casing): also when
  the title's acronym (M2) equals it;
* s is a bare number: also the entry whose project id it is;
* s is quoted ("..."): the normalized title contains the phrase.

Results are ordered by Jaccard desc, title length, project id; the first 10
are returned, relevance = max(1 - 0.1 * position, 0.1).

No list of a frequent key is joined pair by pair.  Strategies are evaluated once
per distinct word set or phrase, and entries once per distinct normalized title (a
*title*; the page needs at most its first 10 entries), so every join below is between
distinct texts.  Every list that a strategy reads is ranked, or cut to its 10 best in
the task that makes it, before anything is shuffled:

* Word sets: exact prefix filtering (Bayardo et al. 2007, All-Pairs; Xiao et al.
  2008, PPJoin): with words in one order, two sets with Jaccard >= 1/2 share a word
  within the first |x| - ceil(|x|/2) + 1 words of *each*; their sizes are within a
  factor 2, and the words after their first shared one still add up.  A pair
  is kept under its first shared word only, where it is verified.
* Acronyms: of an acronym's entries the page can only need its 10 best by length
  and id, and of those that also hold the strategy's one word the 10 best by word
  count, length and id.  Both lists are ranked in the index.
* Phrases: a title that holds a phrase ranks by its word count, length and id, whatever
  the phrase.  So one and two words read a ranked list; longer phrases start from
  their rarest word triple's postings and keep the titles that continue with the
  phrase at that place, as two digests of its text tell where the title lies: neither
  titles nor phrases are sent along with the places.

The index (``build_index``) is a set of tables.  ``save_index`` keeps them bucketed and
sorted by their join keys, so that later searches shuffle no catalog table;
``extend_index`` adds entries.  The order of words is that of the first build:
any order is exact, as long as both sides use the same.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gleaner.fixed_values import PAGE_SIZE  # results per search request
from gleaner.functions import text as TX
from gleaner.operators.editjoin import edit_join
from gleaner.session import materialize

ACRONYM_TOKEN_PREFIX = "\u0001"
#: Words in a row whose places in titles are listed.
GRAM = 3


def strategies(queries: DataFrame) -> DataFrame:
    """(query_no, strategy_no, strategy) -- the query, the quoted query,
    its acronym; nulls and empties dropped, duplicates removed keeping order."""
    q = F.col("query")
    arr = F.array(q, F.concat(F.lit('"'), q, F.lit('"')), TX.extract_acronym(q))
    arr = F.array_distinct(F.filter(arr, lambda s: s.isNotNull() & (s != "")))
    return queries.select("query_no", "query", F.posexplode(arr).alias("strategy_no", "strategy"))


def is_phrase(s: Column) -> Column:
    return (F.length(s) >= 2) & s.startswith('"') & s.endswith('"')


def _acronym_token(s: Column) -> Column:
    up = F.upper(TX.py_strip(s))
    return F.when(up.rlike(TX.ACRONYM_RE), F.concat(F.lit(ACRONYM_TOKEN_PREFIX), up))


def _words(norm: Column) -> Column:
    return F.array_distinct(F.filter(F.split(norm, " "), lambda w: w != ""))


def strategy_terms(strats: DataFrame) -> DataFrame:
    """Adds: is_phrase, phrase_norm, words (distinct), acr (acronym token)."""
    s = F.col("strategy")
    phrase = is_phrase(s)
    inner = F.when(phrase, F.expr("substring(strategy, 2, length(strategy) - 2)")).otherwise(s)
    norm = TX.normalize(inner)
    bare = TX.py_strip(s)
    return strats.select("*", phrase.alias("is_phrase"), norm.alias("phrase_norm"),
                         _words(norm).alias("words"), F.when(~phrase, _acronym_token(s)).alias("acr"),
                         F.when(~phrase & bare.rlike("^[0-9]+$"), bare).alias("id_query"))


# ---------------------------------------------------------------- index

@dataclass(frozen=True)
class Index:
    """The catalog's tables.

    entries    project_id, title_norm, title_len, acr
    texts      project_id, title, description, title_norm: what results show; an index that is not saved reads it
               from the catalog, as descriptions are nearly all of it
    titles     cid, seq (words in order), words, n, title_len, best: a distinct normalized title and its
               first entries (best[0] is cid's); an extended index may hold a title several times
    words      token, df: the frozen order of words
    prefixes   token, r, cid, sorted_words, n, title_len: first words of each title in that order
    grams      gram, place, cid, n: word triples with their places
    gram_sizes gram, many
    ranked     gram, cid, n, title_len: the first titles of each word and word pair
    acronyms   acr, word, project_id, title_len, entry_words: the first entries of each acronym
    saved      whether the tables lie bucketed, so that a search shuffles none of them
    """

    entries: DataFrame
    texts: DataFrame
    titles: DataFrame
    words: DataFrame
    prefixes: DataFrame
    grams: DataFrame
    gram_sizes: DataFrame
    ranked: DataFrame
    acronyms: DataFrame
    saved: bool = False


#: Join key of each table, by which a saved index is bucketed and sorted.
INDEX_KEYS = {"entries": "project_id", "texts": "project_id", "titles": "cid", "words": "token", "prefixes": "token",
              "grams": "gram", "gram_sizes": "gram", "ranked": "gram", "acronyms": "acr"}


def _first(rows: DataFrame, keys: list[str], order: list, most: int = PAGE_SIZE) -> DataFrame:
    """The first rows of each key; planned as a limit inside the tasks, then one after the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_place", F.row_number().over(w)).filter(F.col("_place") <= most).drop("_place")


def catalog_entries(catalog: DataFrame) -> DataFrame:
    """Catalog with normalized title and acronym token (once)."""
    return catalog.select("project_id", TX.normalize(F.col("title")).alias("title_norm"), F.length("title").alias("title_len"),
                          _acronym_token(TX.extract_acronym(F.col("title"))).alias("acr"))


def catalog_texts(catalog: DataFrame) -> DataFrame:
    return catalog.select("project_id", "title", "description", TX.normalize(F.col("title")).alias("title_norm"))


def _titles(entries: DataFrame) -> DataFrame:
    first = _first(entries.filter(F.size(_words(F.col("title_norm"))) > 0).select("title_norm", "title_len", "project_id"), ["title_norm"], ["title_len", "project_id"])
    best = first.groupBy("title_norm").agg(F.sort_array(F.collect_list(F.struct("title_len", "project_id"))).alias("best"))  # a page at most
    seq = F.split("title_norm", " ")
    return best.select(F.col("best")[0]["project_id"].alias("cid"), seq.alias("seq"), _words(F.col("title_norm")).alias("words"),
                       F.col("best")[0]["title_len"].alias("title_len"), "best").withColumn("n", F.size("words"))


def _ordered(sets: DataFrame, key: str, words: DataFrame) -> DataFrame:
    """(key, sorted_words): each set in the order of (document frequency, word), unknown words first."""
    w = sets.select(key, F.explode("words").alias("token")).join(words, "token", "left")
    pair = F.struct(F.coalesce("df", F.lit(0)).alias("df"), "token")
    return w.groupBy(key).agg(F.transform(F.sort_array(F.collect_list(pair)), lambda x: x["token"]).alias("sorted_words"))


def _prefix(sets: DataFrame) -> DataFrame:
    """The first n - ceil(n/2) + 1 words of each ordered set, with their rank from 1."""
    keep = (F.col("n") - F.ceil(F.col("n") / 2) + 1).cast("int")
    return sets.select("*", F.posexplode(F.slice("sorted_words", F.lit(1), keep)).alias("r", "token")).withColumn("r", F.col("r") + 1)


def _runs(seq: Column, n: int) -> Column:
    """The texts of ``n`` words in a row, by place; null where there are fewer words."""
    at = F.sequence(F.lit(0), F.size(seq) - n)
    return F.when(F.size(seq) >= n, F.transform(at, lambda i: F.concat_ws(" ", *[F.get(seq, i + k) for k in range(n)])))


def _digests(text: Column) -> tuple[Column, Column]:
    """Of equal texts only: 64 bits, and 128 that are worked out where these agree."""
    return F.xxhash64(text), F.unhex(F.md5(text))


def _postings(entries: DataFrame, titles: DataFrame, words: DataFrame) -> dict[str, DataFrame]:
    """The tables that rest on entries and titles, given the order of words."""
    prefixes = _prefix(titles.select("cid", "n", "title_len").join(_ordered(titles, "cid", words), "cid"))
    pairs = _runs(F.col("seq"), 2)
    grams = titles.select("cid", "n", F.posexplode(_runs(F.col("seq"), GRAM)).alias("place", "gram"))
    short = titles.select("cid", "n", "title_len", F.explode(F.array_distinct(F.concat("words", F.coalesce(pairs, F.array().cast("array<string>"))))).alias("gram"))
    known = entries.filter(F.col("acr").isNotNull()).withColumn("words", _words(F.col("title_norm")))
    own = F.filter("words", lambda w: F.concat(F.lit(ACRONYM_TOKEN_PREFIX), F.upper(w)) == F.col("acr"))
    lists = known.select("acr", F.explode(F.concat(F.array(F.lit(None).cast("string")), own)).alias("word"), "project_id", "title_len",
                         F.col("words").alias("entry_words"))
    by_size = F.when(F.col("word").isNotNull(), F.size("entry_words"))
    return {"prefixes": prefixes, "grams": grams, "gram_sizes": grams.groupBy("gram").agg(F.count("*").alias("many")),
            "ranked": _first(short, ["gram"], ["n", "title_len", "cid"]),
            "acronyms": _first(lists, ["acr", "word"], [by_size, "title_len", "project_id"])}


def build_index(catalog: DataFrame) -> Index:
    entries = materialize(catalog_entries(catalog))
    titles = materialize(_titles(entries))
    words = materialize(titles.select(F.explode("words").alias("token")).groupBy("token").agg(F.count("*").alias("df")))
    return Index(entries, catalog_texts(catalog), titles, words, **_postings(entries, titles, words))


def _table(name: str, part: str) -> str:
    return f"{name}_{part}"


def _write(index: Index, name: str, buckets: int, mode: str, parts: list[str], folder: str | None) -> None:
    for part in parts:
        key, table = INDEX_KEYS[part], _table(name, part)
        out = getattr(index, part).write.mode(mode).format("parquet").bucketBy(buckets, key).sortBy(key)
        (out.option("path", f"{folder.rstrip('/')}/{table}") if folder else out).saveAsTable(table)


def save_index(index: Index, name: str, buckets: int = 16, folder: str | None = None) -> Index:
    """Keep the index as tables ``name_*`` of the session catalog, bucketed and sorted by their join keys.

    The files lie in the warehouse, or in a shared ``folder``.
    """
    _write(index, name, buckets, "overwrite", list(INDEX_KEYS), folder)
    return open_index(index.entries.sparkSession, name)


def open_index(spark: SparkSession, name: str) -> Index:
    return Index(**{part: spark.table(_table(name, part)) for part in INDEX_KEYS}, saved=True)


def extend_index(spark: SparkSession, name: str, catalog: DataFrame, buckets: int = 16, folder: str | None = None) -> Index:
    """Add entries with new project ids to a saved index: only their own rows are computed and appended.

    The ranked lists may then hold more than a page for a key, and a title may stand there twice.
    """
    old = open_index(spark, name)
    entries = materialize(catalog_entries(catalog))
    titles = materialize(_titles(entries))
    new = Index(entries, catalog_texts(catalog), titles, old.words, **_postings(entries, titles, old.words))
    new = replace(new, **{part: materialize(getattr(new, part)) for part in ("prefixes", "grams", "gram_sizes", "ranked", "acronyms")})
    _write(new, name, buckets, "append", [part for part in INDEX_KEYS if part != "words"], folder)
    return open_index(spark, name)


# ---------------------------------------------------------------- search

def _set_pages(sets: DataFrame, index: Index) -> DataFrame:
    """(key, cid, overlap, jaccard, title_len) of the best titles for each distinct word set (key, words, n)."""
    s = (_prefix(sets.select("key", "n").join(_ordered(sets, "key", index.words), "key"))
         .select("key", "token", F.col("sorted_words").alias("sw"), F.col("n").alias("sn"), F.col("r").alias("sr")))
    # Sharing a word at ranks (sr, r) leaves at most 1 + min(sn - sr, n - r) shared words; a match needs ceil((sn + n) / 3).
    n, sn = F.col("n"), F.col("sn")
    fits = (2 * n >= sn) & (n <= 2 * sn) & (3 * (1 + F.least(sn - F.col("sr"), n - F.col("r"))) >= sn + n)
    met = s.join(index.prefixes, "token").filter(fits).select("key", "cid", "token", "title_len", "n", "sn", F.array_intersect("sw", "sorted_words").alias("both"))
    overlap = F.size("both")
    good = met.filter((F.col("both")[0] == F.col("token")) & (3 * overlap >= n + sn)).select(
        "key", "cid", overlap.alias("overlap"), (overlap / (n + sn - overlap)).alias("jaccard"), "title_len")
    return _first(good, ["key"], [F.col("jaccard").desc(), "title_len", "cid"])


def _phrase_pages(phrases: DataFrame, index: Index) -> DataFrame:
    """The same for each distinct phrase (key, seq, n: its distinct words)."""
    rated = lambda rows: rows.select("key", "cid", F.col("pn").alias("overlap"), (F.col("pn") / F.col("n")).alias("jaccard"), "title_len")
    p = phrases.withColumnRenamed("n", "pn")
    short = p.filter(F.size("seq") <= 2).select("key", "pn", F.concat_ws(" ", "seq").alias("gram")).join(index.ranked, "gram")
    long_ = p.filter(F.size("seq") > 2)
    grams = long_.select("key", F.posexplode(_runs(F.col("seq"), GRAM)).alias("i", "gram"))
    sizes = index.gram_sizes.groupBy("gram").agg(F.sum("many").alias("many"))  # an extended index has a row per extension
    rarest = grams.join(sizes, "gram").groupBy("key").agg(F.min(F.struct("many", "gram", "i")).alias("m")).select("key", "m.gram", "m.i")
    brief, sure = _digests(F.array_join("seq", " "))
    asked = rarest.join(long_.select("key", "pn", F.size("seq").alias("pl"), brief.alias("brief"), sure.alias("sure")), "key")
    at = asked.join(index.grams.select("gram", "place", "cid"), "gram").filter(F.col("place") >= F.col("i")).withColumn(
        "start", F.col("place") - F.col("i")).drop("gram", "i", "place")
    brief, sure = _digests(F.array_join(F.slice("held", F.col("start") + 1, F.col("pl")), " "))
    hits = (at.join(index.titles.select("cid", F.col("seq").alias("held"), "n", "title_len"), "cid")
            .filter((brief == F.col("brief")) & (sure == F.col("sure"))).select("key", "cid", "pn", "n", "title_len").distinct())
    return _first(rated(short).unionByName(rated(hits)), ["key"], [F.col("jaccard").desc(), "title_len", "cid"])


def _numbered(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` with a number each; written, so that the numbers stay as they are."""
    return materialize(rows.withColumn(name, F.monotonically_increasing_id()))


def pages(queries: DataFrame, index: Index, page_size: int = PAGE_SIZE) -> DataFrame:
    """The result page of every strategy of every query: query_no, query, strategy_no, strategy, project_id, overlap, pos.

    Strategies and their texts go by number: a text is as long as the words and word pairs
    that it is cut into are many, so no row of those carries it.
    """
    if page_size > PAGE_SIZE:
        raise ValueError(f"the index ranks {PAGE_SIZE} results")
    asked = materialize(strategies(queries))
    key = F.when(F.col("is_phrase"), F.concat(F.lit('"'), "phrase_norm")).otherwise(F.array_join(F.array_sort("words"), " "))
    terms = _numbered(strategy_terms(asked.select("strategy").distinct()).select("strategy", "acr", "id_query", key.alias("text")), "sid")

    # A phrase's text starts with the quote, which no normalized text holds.
    texts = _numbered(terms.filter(~F.col("text").isin("", '"')).select("text").distinct(), "key")
    phrase = F.col("text").startswith('"')
    said = texts.filter(phrase).select("key", F.expr("substring(text, 2)").alias("phrase_norm"))
    sets = texts.filter(~phrase).select("key", _words(F.col("text")).alias("words")).withColumn("n", F.size("words"))
    phrases = said.select("key", F.split("phrase_norm", " ").alias("seq"), F.size(_words(F.col("phrase_norm"))).alias("n"))
    # Ten rows of a text are left.  Written one by one, the shuffles of the index's words and word pairs go before the next are made.
    found_by = [_set_pages(sets, index), _phrase_pages(phrases, index)]
    by_set, by_phrase = found_by if index.saved else map(materialize, found_by)
    titles = by_set.unionByName(by_phrase)
    order = [F.col("jaccard").desc(), "title_len", "project_id"]
    found = _first(titles.join(index.titles.select("cid", "best"), "cid").select("key", "overlap", "jaccard", F.inline("best")), ["key"], order)

    # What acronyms and bare ids add to a strategy's page.
    plain = terms.filter(~phrase).withColumn("words", _words(F.col("text")))
    spelled = plain.filter(F.col("acr").isNotNull()).select("sid", "words", "acr").join(index.acronyms, "acr").filter(
        F.col("word").isNull() | F.array_contains("words", F.col("word"))).select("sid", "words", "project_id", "title_len", "entry_words")
    numbered = plain.filter(F.col("id_query").isNotNull()).select("sid", "words", F.col("id_query").alias("project_id")).join(
        index.entries.select("project_id", "title_len", _words(F.col("title_norm")).alias("entry_words")), "project_id").select(*spelled.columns)
    o = F.size(F.array_intersect("words", "entry_words"))
    either = F.size("words") + F.size("entry_words") - o
    more = spelled.unionByName(numbered).select("sid", "project_id", "title_len", o.alias("overlap"),
                                                F.when(either > 0, o / either).otherwise(F.lit(0.0)).alias("jaccard"))
    keys = terms.select("sid", "text").join(texts.select("text", "key"), "text").select("sid", "key")
    listed = keys.join(found, "key").drop("key").unionByName(more).dropDuplicates(["sid", "project_id"])
    place = F.row_number().over(Window.partitionBy("sid").orderBy(*order))
    page = listed.withColumn("rn", place).filter(F.col("rn") <= page_size).select("sid", "project_id", "overlap", (F.col("rn") - 1).alias("pos"))
    return asked.join(terms.select("strategy", "sid"), "strategy").join(page, "sid").select(
        "query_no", "query", "strategy_no", "strategy", "project_id", "overlap", "pos")


def shown(results: DataFrame, index: Index, cut: int | None = None) -> DataFrame:
    """Adds the entry of ``project_id`` to rows: title, description (its first ``cut`` characters), title_norm, desc_norm."""
    description = F.col("description") if cut is None else F.substring("description", 1, cut).alias("description")
    # the description is normalized once per entry here, not once per result
    return results.join(index.texts.select("project_id", "title", description, "title_norm",
                                             TX.normalize(F.col("description")).alias("desc_norm")), "project_id")


def relevance(pos: Column) -> Column:
    """From the place of a result on its page."""
    return F.greatest(F.round((F.lit(10) - pos) / F.lit(10.0), 1), F.lit(0.1))


def search(queries: DataFrame, catalog: DataFrame | None, page_size: int = PAGE_SIZE, index: Index | None = None) -> DataFrame:
    """J1 + A6 + A7: the result page of every strategy of every query.

    Reads ``index``, or one that it builds over ``catalog``; pages of at most
    ``PAGE_SIZE`` results.  Returns query_no, query, strategy_no, strategy, pos,
    relevance_score, project_id, title, description, title_norm, overlap, desc_norm.
    """
    if page_size > PAGE_SIZE:
        raise ValueError(f"the index ranks {PAGE_SIZE} results")
    index = index or build_index(catalog)
    return shown(pages(queries, index, page_size), index).select(
        "query_no", "query", "strategy_no", "strategy", "pos", relevance(F.col("pos")).alias("relevance_score"),
        "project_id", "title", "description", "title_norm", "overlap", "desc_norm",
    )


def misspelt(queries: DataFrame, catalog: DataFrame | None, per_cent: int = 85, page_size: int = PAGE_SIZE, index: Index | None = None) -> DataFrame:
    """The page of titles that each query is within edit similarity ``per_cent`` of, whether or not they share a word.

    Query and title are compared normalized; order: edit distance, title length,
    project id.  Returns query_no, query, pos, project_id, distance, title.
    """
    if page_size > PAGE_SIZE:
        raise ValueError(f"the index ranks {PAGE_SIZE} results")
    index = index or build_index(catalog)
    named = materialize(queries.select("query_no", "query", TX.normalize(F.col("query")).alias("left")))
    titles = index.titles.select(F.concat_ws(" ", "seq").alias("right"), "best")
    near = edit_join(named.select(F.col("left").alias("text")), titles.select(F.col("right").alias("text")), per_cent)
    # estimated by the size of their files, texts look small enough to go through the driver
    listed = near.hint("merge").join(titles, "right").select("left", "distance", F.inline("best"))
    page = _first(listed, ["left"], ["distance", "title_len", "project_id"], page_size)
    pos = F.row_number().over(Window.partitionBy("left").orderBy("distance", "title_len", "project_id")) - 1
    return (named.hint("merge").join(page.withColumn("pos", pos), "left").hint("merge").join(index.texts.select("project_id", "title"), "project_id")
            .select("query_no", "query", "pos", "project_id", "distance", "title"))
