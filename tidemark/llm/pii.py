"""Personal data: patterned spans, and words that give them away."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import staged, texts

# --- Fixed values: the patterns of the contract, written so that no search is quadratic ---
KINDS = ["email", "ip", "card", "phone"]
# A match may begin where the last one ended, or else only at the start of a run.
EMAIL = (
    r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@"
    r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
)
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
CARD_DIGITS, PHONE_DIGITS = (13, 19), (9, 15)
# --- End of fixed values ---

# Single separators between digits become JOINT, so that a card is a run of one class.
JOINT, NOT_JOINT = "\x01", "\x02"
SEPARATOR = r"(?<=[0-9])[\x20-](?=[0-9])"
CARD_RUN = rf"(?<![0-9{JOINT}])[0-9][0-9{JOINT}]{{12,}}"

TERM = r"[\p{L}\p{M}\p{N}]+"  # words that may give an entity away
NOT_TERM = r"[^\p{L}\p{M}\p{N}]+"
DISCLOSURE = 0.9  # share of an entity's information that a term may not reach
MOST_SEARCHED = 1000  # terms of a document that one search looks for
BITMAP_WORDS = 1 << 19  # of 64 bits: what is broadcast of a set of words, at most
SMOOTHING = 0.5  # documents without the entity that every term is taken to have besides


def found(text: Column, pattern: str | Column) -> Column:
    """All matches, leftmost first, as structs of start, end and value."""
    pattern = F.lit(pattern) if isinstance(pattern, str) else pattern
    matches = F.regexp_extract_all(text, pattern, F.lit(0))
    gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(matches))
    steps = F.zip_with(gaps, matches, lambda g, m: F.struct(F.length(g).alias("gap"), m.alias("value")))
    start = F.struct(
        F.lit(0).alias("at"),
        F.expr("cast(array() as array<struct<start:int,end:int,value:string>>)").alias("out"),
    )

    def add(done, step):
        begin = done["at"] + step["gap"]
        end = begin + F.length(step["value"])
        span = F.struct(begin.alias("start"), end.alias("end"), step["value"].alias("value"))
        return F.struct(end.alias("at"), F.concat(done["out"], F.array(span)).alias("out"))

    return F.aggregate(steps, start, add, lambda done: done["out"])


NONE = "cast(array() as array<struct<start:int,end:int,value:string>>)"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """The check sum; only asked for 13 to 19 digits."""
    back = F.reverse(digits)

    def add(total, i):
        d = F.substr(back, i, F.lit(1)).try_cast("int")
        twice = d * 2
        return total + F.when(i % 2 == 1, d).when(twice > 9, twice - 9).otherwise(twice)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def base_spans(text: Column) -> dict[str, Column]:
    """Checked spans of each kind. A cheap test keeps most texts from the searches."""
    part = lambda p: F.regexp_replace(p, "^0+", "")
    small = lambda p: (F.length(part(p)) <= 3) & (F.coalesce(part(p).try_cast("int"), F.lit(0)) <= 255)
    joined = F.regexp_replace(F.translate(text, JOINT, NOT_JOINT), SEPARATOR, JOINT)
    n = lambda s: F.length(_digits(s["value"]))
    none = F.expr(NONE)
    return {
        "email": F.when(F.contains(text, F.lit("@")), found(text, EMAIL)).otherwise(none),
        "ip": F.when(
            F.rlike(text, F.lit(r"[0-9]\.[0-9]")),
            F.filter(found(text, IP), lambda s: F.forall(F.split(s["value"], r"\."), small)),
        ).otherwise(none),
        "card": F.when(
            F.rlike(text, F.lit(r"[0-9](?:[\x20-]?[0-9]){12}")),
            F.filter(
                found(joined, CARD_RUN),
                lambda s: F.when(n(s).between(*CARD_DIGITS), _luhn(_digits(s["value"]))).otherwise(False),
            ),
        ).otherwise(none),
        "phone": F.when(
            F.rlike(text, F.lit(r"\+[0-9]")),
            F.filter(found(text, PHONE), lambda s: n(s).between(*PHONE_DIGITS)),
        ).otherwise(none),
    }


def _entities() -> Column:
    """All spans of a row with their kind; an entity is a kind and a value."""
    value = {
        "email": lambda s: F.lower(s["value"]),
        "ip": lambda s: s["value"],
        "card": lambda s: _digits(s["value"]),
        "phone": lambda s: F.concat(F.lit("+"), _digits(s["value"])),
    }

    def named(kind):
        return F.transform(
            kind,
            lambda s: F.struct(
                s["start"].alias("start"),
                s["end"].alias("end"),
                F.concat(F.lit(f"{kind}:"), value[kind](s)).alias("entity"),
            ),
        )

    return F.concat(*[named(kind) for kind in KINDS])


def _blanked() -> Column:
    """The text with spaces in place of every span, so that all other words stay where they are."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def add(done, s):
        gap = F.substr(F.col("text"), done["at"] + 1, F.greatest(s["start"] - done["at"], F.lit(0)))
        blank = F.repeat(F.lit(" "), F.greatest(s["end"] - F.greatest(done["at"], s["start"]), F.lit(0)))
        return F.struct(
            F.greatest(done["at"], s["end"]).alias("at"),
            F.concat(done["out"], gap, blank).alias("out"),
        )

    rest = lambda done: F.concat(done["out"], F.substr(F.col("text"), done["at"] + 1))
    return F.when(
        F.size("entities") > 0, F.aggregate(F.array_sort("entities"), start, add, rest)
    ).otherwise(F.col("text"))


def spotted(docs: DataFrame) -> DataFrame:
    """Rows ``rid``, ``doc_id``: spans of each kind, ``entities``, and ``body``, the text without
    them. Written once, so that a row keeps its key."""
    rows = texts(docs).withColumn("rid", F.monotonically_increasing_id())
    rows = rows.withColumns(base_spans(F.col("text"))).withColumn("entities", _entities())
    return staged(
        rows.withColumn("body", _blanked()).select(
            "rid",
            "doc_id",
            *[F.transform(k, lambda s: F.struct(s["start"], s["end"])).alias(k) for k in KINDS],
            F.array_distinct(F.transform("entities", lambda e: e["entity"])).alias("entities"),
            "body",
        ),
        "spotted",
    )


def _terms(rows: DataFrame) -> DataFrame:
    """``rid`` and each of its distinct words, in lower case."""
    words = F.array_distinct(F.split(F.lower("body"), NOT_TERM))
    return rows.select("rid", F.explode(words).alias("term")).filter("term <> ''")


def _maybe_among(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """``rows`` whose ``key`` may be one of ``keys``: all that are, and few others.

    The set is a bitmap of hashes, whose size doesn't grow with it and which may therefore be
    broadcast. Most of a corpus ends here instead of in a shuffle; an exact join follows.
    """
    bit = F.pmod(F.xxhash64(key), F.lit(64 * BITMAP_WORDS))
    mask = F.expr("shiftleft(1L, cast(_bit & 63 as int))")
    bitmap = (
        keys.select(bit.alias("_bit"))
        .groupBy(F.shiftright("_bit", 6).alias("_word"))
        .agg(F.bit_or(mask).alias("_bits"))
    )
    return (
        rows.withColumn("_bit", bit)
        .withColumn("_word", F.shiftright("_bit", 6))
        .join(F.broadcast(bitmap), "_word")
        .filter(F.col("_bits").bitwiseAND(mask) != 0)
        .drop("_bit", "_word", "_bits")
    )


def revealing(rows: DataFrame) -> DataFrame:
    """``term``: its information about some entity is too high.

    Counted in whole documents over the whole corpus. A term's pointwise mutual information
    with an entity is compared with the entity's own information, log P(e | t) / P(e) >=
    DISCLOSURE * -log P(e), where P(e | t) is smoothed by ``SMOOTHING`` documents that hold the
    term and are like any other. There is no least number of documents: a word found nowhere
    but beside an entity gives it away. An entity in every document tells nothing.

    Only terms rare enough to qualify meet the entities of a document; a common word would
    have to stand in most of the entity's documents and few others.
    """
    n = rows.count()
    entity_rows = rows.select("rid", F.explode("entities").alias("entity"))
    entity_docs = staged(entity_rows.groupBy("entity").agg(F.count("*").alias("n_entity")), "entities")
    beside_terms = staged(_terms(rows.filter(F.size("entities") > 0)), "beside")
    wanted = staged(beside_terms.select("term").distinct(), "wanted")
    term_docs = (
        _maybe_among(_terms(rows), wanted, "term").groupBy("term").agg(F.count("*").alias("n_term"))
    )
    share = F.col("n_entity") / F.lit(float(n))
    least = F.pow(share, F.lit(1 - DISCLOSURE))
    mostly = (F.col("n_entity") + SMOOTHING * share) / least  # of a term's documents, smoothed
    beside = entity_rows.join(entity_docs.filter(F.col("n_entity") < n), "entity").withColumn(
        "most", mostly + 1e-6
    )
    known = beside_terms.join(staged(term_docs, "terms"), "term")
    together = (
        beside.join(known, "rid")
        .filter(F.col("n_term") + SMOOTHING <= F.col("most"))
        .groupBy("entity", "n_entity", "term", "n_term")
        .agg(F.count("*").alias("n_both"))
    )
    given = (F.col("n_both") + SMOOTHING * share) / (F.col("n_term") + SMOOTHING)
    return together.filter(given >= least).select("term").distinct()


def _searched(held: DataFrame) -> DataFrame:
    """Places of ``terms`` in ``lower``, as a search for any of them as a whole word."""
    edge = TERM.removesuffix("+")
    pattern = F.concat(
        F.lit(f"(?<!{edge})(?:"), F.array_join("terms", "|"), F.lit(f")(?!{edge})")
    )
    spans = F.transform(
        found(F.col("lower"), pattern), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))
    )
    return held.select("rid", spans.alias("term"))


def _word_by_word(held: DataFrame) -> DataFrame:
    """The same for rows with very many terms, or whose letters change in number in lower case:
    every word is a row, and starts are running sums over a document's words."""
    words = F.regexp_extract_all("body", F.lit(TERM), F.lit(0))
    pieces = F.arrays_zip(
        F.split("body", TERM, -1).alias("gap"), F.concat(words, F.array(F.lit(""))).alias("word")
    )
    each = held.select("rid", F.posexplode(pieces).alias("i", "piece"))
    upto = Window.partitionBy("rid").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    ends = each.select("rid", "i", F.length("piece.gap").alias("gap"), "piece.word").withColumn(
        "end", F.sum(F.col("gap") + F.length("word")).over(upto)
    )
    span = F.struct(
        (F.col("end") - F.length("word")).cast("int").alias("start"), F.col("end").cast("int").alias("end")
    )
    own = held.select("rid", F.explode("terms").alias("term"))
    return (
        ends.withColumn("term", F.lower("word"))
        .join(own, ["rid", "term"])
        .groupBy("rid")
        .agg(F.array_sort(F.collect_list(span)).alias("term"))
    )


def find(docs: DataFrame) -> DataFrame:
    """Per row ``rid``, ``doc_id``, ``body``, an array of (start, end) for each kind, and ``term``.

    Every occurrence of a revealing word is found, in all documents. Only texts that have one
    are shuffled and searched.
    """
    rows = spotted(docs)
    terms = staged(revealing(rows), "revealing")
    own = _maybe_among(_terms(rows), terms, "term").join(terms, "term")
    own = staged(own.groupBy("rid").agg(F.collect_list("term").alias("terms")), "holders")
    held = staged(
        _maybe_among(rows.select("rid", "body"), own.select("rid"), "rid")
        .join(own, "rid"),
        "held",
    ).withColumn("lower", F.lower("body"))
    plain = (F.size("terms") <= MOST_SEARCHED) & (F.length("lower") == F.length("body"))
    spans = _searched(held.filter(plain)).unionByName(_word_by_word(held.filter(~plain)))
    return rows.join(spans, "rid", "left")


def personal_data(docs: DataFrame) -> DataFrame:
    """Per document: ``n_email``, ``n_ip``, ``n_card``, ``n_phone``, ``n_term``,
    ``base_sha256`` and ``spans``.

    Spans are code points with the end exclusive. Null and empty texts have none. Beside the
    patterned spans stand ``term`` spans: every occurrence, in any document, of a word outside
    the patterned spans that by counts over the whole corpus discloses an entity. Rows
    repeated under one id are documents of their own; an empty table gives an empty result;
    other columns are not read.
    """
    listed = lambda k: F.transform(
        k, lambda s: F.concat_ws(":", F.lit(k), s["start"].cast("string"), s["end"].cast("string"))
    )
    base = F.concat(*[listed(k) for k in KINDS])
    everything = F.concat(base, F.coalesce(listed("term"), F.array().cast("array<string>")))
    return find(docs).select(
        "doc_id",
        *[F.size(k).cast("bigint").alias(f"n_{k}") for k in KINDS],
        F.coalesce(F.size("term"), F.lit(0)).cast("bigint").alias("n_term"),
        F.sha2(F.array_join(base, ","), 256).alias("base_sha256"),
        F.array_join(everything, ",").alias("spans"),
    )


def redacted(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` with each patterned span generalised to its kind in brackets and
    each revealing word removed. Of overlapping spans the one that starts first counts.

    One row for each row, whatever its id. Patterned spans are blank in the text that was
    written, so nothing of them is read again.
    """
    tagged = lambda k, label: F.transform(
        F.coalesce(k, F.array().cast("array<struct<start:int,end:int>>")),
        lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(label).alias("label")),
    )
    spans = F.array_sort(F.concat(*[tagged(F.col(k), f"[{k.upper()}]") for k in KINDS], tagged(F.col("term"), "")))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def add(done, s):
        gap = F.substr(F.col("body"), done["at"] + 1, s["start"] - done["at"])
        longer = F.struct(s["end"].alias("at"), F.concat(done["out"], gap, s["label"]).alias("out"))
        within = F.struct(F.greatest(done["at"], s["end"]).alias("at"), done["out"].alias("out"))
        return F.when(s["start"] >= done["at"], longer).otherwise(within)

    text = F.aggregate(
        "spans", start, add, lambda done: F.concat(done["out"], F.substr(F.col("body"), done["at"] + 1))
    )
    return find(docs).withColumn("spans", spans).select("doc_id", text.alias("text"))


def oracle() -> str:
    """The same in SQL, with the patterns as the contract states them."""
    patterns = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }

    def spans(source: str, columns: str, kind: str, text: str, pattern: str) -> str:
        return f"""
SELECT {columns}, '{kind}' AS kind, i,
       list_sum([length(g) for g in gaps[1:i]])::BIGINT
           + coalesce(list_sum([length(v) for v in hits[1:i - 1]]), 0)::BIGINT AS s, hits[i] AS v
FROM (SELECT *, unnest(range(1, len(hits) + 1)) AS i FROM (
    SELECT {columns}, regexp_extract_all({text}, '{pattern}') AS hits,
           string_split_regex({text}, '{pattern}') AS gaps FROM {source}))"""

    base = " UNION ALL ".join(spans("t", "rid", k, "text", p) for k, p in patterns.items())
    return f"""
WITH t AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
raw AS ({base}),
digits AS (SELECT *, regexp_replace(v, '[^0-9]', '', 'g') AS d FROM raw),
checked AS (
    SELECT rid, kind, s, s + length(v) AS e,
           kind || ':' || CASE kind WHEN 'email' THEN lower(v) WHEN 'ip' THEN v
                               WHEN 'card' THEN d ELSE '+' || d END AS entity
    FROM digits
    WHERE CASE kind
        WHEN 'email' THEN TRUE
        WHEN 'ip' THEN len([p for p in string_split(v, '.') if length(ltrim(p, '0')) > 3
                            OR coalesce(try_cast(ltrim(p, '0') AS INTEGER), 0) > 255]) = 0
        WHEN 'card' THEN length(d) BETWEEN 13 AND 19 AND list_sum([
                CASE WHEN k % 2 = 1 THEN reverse(d)[k]::INTEGER
                     WHEN reverse(d)[k]::INTEGER > 4 THEN 2 * reverse(d)[k]::INTEGER - 9
                     ELSE 2 * reverse(d)[k]::INTEGER END for k in range(1, length(d) + 1)]) % 10 = 0
        ELSE length(d) BETWEEN 9 AND 15 END
), chars AS (
    SELECT rid, i, substr(text, i, 1) AS c
    FROM (SELECT rid, text, unnest(range(1, length(text) + 1)) AS i
          FROM t WHERE rid IN (SELECT rid FROM checked))
), blanked AS (
    SELECT rid, string_agg(CASE WHEN EXISTS (
        SELECT 1 FROM checked s WHERE s.rid = c.rid AND c.i > s.s AND c.i <= s.e)
        THEN ' ' ELSE c END, '' ORDER BY i) AS body
    FROM chars c GROUP BY rid
), bodies AS (
    SELECT rid, text AS body FROM t WHERE rid NOT IN (SELECT rid FROM blanked)
    UNION ALL SELECT rid, body FROM blanked
), words AS ({spans("bodies", "rid", "term", "body", TERM)}),
held AS (SELECT DISTINCT rid, lower(v) AS term FROM words),
entity_docs AS (SELECT entity, count(DISTINCT rid) AS n_entity FROM checked GROUP BY entity),
term_docs AS (SELECT term, count(*) AS n_term FROM held GROUP BY term),
together AS (
    SELECT entity, term, count(*) AS n_both
    FROM (SELECT DISTINCT rid, entity FROM checked) JOIN held USING (rid) GROUP BY ALL
), sized AS (SELECT count(*)::DOUBLE AS n FROM t),
revealing AS (
    SELECT DISTINCT term
    FROM together JOIN entity_docs USING (entity) JOIN term_docs USING (term), sized
    WHERE n_entity < n
      AND (n_both + {SMOOTHING} * (n_entity / n)) / (n_term + {SMOOTHING}) >= pow(n_entity / n, {1 - DISCLOSURE!r})
), spans AS (
    SELECT rid, kind, s, e FROM checked
    UNION ALL
    SELECT rid, 'term', s, s + length(v) FROM words WHERE lower(v) IN (SELECT term FROM revealing)
), listed AS (
    SELECT rid, kind, kind || ':' || s || ':' || e AS item, s,
           list_position(['email', 'ip', 'card', 'phone', 'term'], kind) AS place FROM spans
)
SELECT t.doc_id,
       count(*) FILTER (kind = 'email') AS n_email, count(*) FILTER (kind = 'ip') AS n_ip,
       count(*) FILTER (kind = 'card') AS n_card, count(*) FILTER (kind = 'phone') AS n_phone,
       count(*) FILTER (kind = 'term') AS n_term,
       sha256(coalesce(string_agg(item, ',' ORDER BY place, s) FILTER (kind <> 'term'), '')) AS base_sha256,
       coalesce(string_agg(item, ',' ORDER BY place, s), '') AS spans
FROM t LEFT JOIN listed USING (rid) GROUP BY t.rid, t.doc_id
"""
