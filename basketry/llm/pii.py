"""Personal data: pattern spans, and terms that reveal them by co-occurrence.

DataFrame functions only. Pattern spans (email, ip, card, phone) are the
protected entities. A term is a word of a document. Over the whole corpus, n_c
documents mention entity c, n_t hold term t, n_ct both, wherever in the document
they stand. All three are numbers of distinct texts: copies of a text are no further
evidence, and doubling a table changes no span. The term discloses

    PMI(c, t) / IC(c) = log(n_ct * N / (n_c * n_t)) / log(N / n_c)

of the entity's information: 1 where the term occurs with this entity only.
Terms seen with it in ``MIN_DOCS`` texts or more that disclose at least
``GENERALISE`` of it are replaced by a general form, from ``REMOVE`` on they
are taken out, at all their places in the texts that mention the entity. Texts
without an entity are left alone.

Every distinct term of a text meets every distinct entity of ``MIN_DOCS`` texts in it, so
a text gives as many rows as the product of both numbers; they are shuffled
and counted, never gathered. Matches come from ``regexp_extract_all`` with the text between
them from ``split``; lengths of both give code-point positions, in parts of ``PART``
matches. Patterns are written possessively and start only where a run starts, which gives
the same leftmost matches without back-tracking or recursion on long runs. Tables join
by shuffle; texts that cannot meet are kept out by a bit map of 4 MB.

Null text is empty. Results hang on the text, joined by its 128-bit hash, so
repeated rows and null ids keep their rows; extra columns are ignored (``sanitise`` keeps
them). A risk equal to a threshold counts. Long texts are searched whole, and an empty
table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.keys import maybe_held
from basketry.session import checkpoint_root

# Fixed order of kinds; patterns equal the contract's up to possessive form.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
# A text without this cannot hold the kind.
_HINTS = {"email": "@", "ip": ".", "phone": "+"}
TERM = r"\p{L}{3,}+"
MIN_DOCS = 2
GENERALISE, REMOVE = 0.8, 0.95
PART = 256
_SPAN = "struct<start:bigint,k:int,end:bigint,kind:string,value:string>"


def _walk(found: str, gaps: str, element: str, entry: str, wanted: str) -> str:
    """SQL: ``entry`` of every match i that is ``wanted``, where ``a.at + length(gaps[i])`` is its start.

    ``found`` are the matches, ``gaps`` the text between them. Lists grow within parts
    of ``PART`` matches only, so that the work is linear in their number.
    """
    step = f"a.at + length({gaps}[i]) + length({found}[i])"
    part = f"sequence(c * {PART}, least(size({found}), (c + 1) * {PART}) - 1)"
    starts = f"""aggregate(sequence(0, (size({found}) - 1) div {PART}),
        named_struct('at', 0L, 'out', cast(array() as array<bigint>)),
        (b, x) -> named_struct('at', aggregate(transform(array(cast(x as int)), c -> {part})[0], b.at,
            (t, i) -> t + length({gaps}[i]) + length({found}[i])),
            'out', concat(b.out, array(b.at))), b -> b.out)"""
    return f"""flatten(transform({starts}, (o, c) -> aggregate({part},
        named_struct('at', o, 'out', cast(array() as array<{element}>)),
        (a, i) -> named_struct('at', {step}, 'out', if({wanted},
            concat(a.out, array({entry})), a.out)), a -> a.out)))"""


def _located(text: str, found: str, gaps: str) -> str:
    """SQL: (start, end, value) of every match, from matches and the text between them."""
    return _walk(found, gaps, "struct<start:bigint,end:bigint,value:string>", f"""named_struct(
        'start', a.at + length({gaps}[i]),
        'end', a.at + length({gaps}[i]) + length({found}[i]), 'value', {found}[i])""", "true")


def _valid(kind: str) -> str:
    """SQL condition on a match ``m``."""
    if kind == "ip":
        part = "0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
        return f"m.value rlike '^{part}([.]{part}){{3}}$'"
    digits = "translate(m.value, ' -+().', '')"
    if kind == "phone":
        return f"length({digits}) between 10 and 15"
    if kind == "card":
        digit = f"cast(substring({digits}, -i, 1) as int)"
        return f"""(length({digits}) between 14 and 19 and aggregate(
            sequence(1, length({digits})), 0, (s, i) -> s + if(i % 2 = 1, {digit},
                if({digit} > 4, 2 * {digit} - 9, 2 * {digit}))) % 10 = 0)"""
    return "true"


def with_base(df: DataFrame, text: str, out: str) -> DataFrame:
    """``df`` with the base spans of column ``text`` in ``out``, by start, then kind."""
    for kind, pattern in PATTERNS.items():
        found = F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0))
        none = F.array().cast("array<string>")
        if kind in _HINTS:
            found = F.when(F.col(text).contains(_HINTS[kind]), found)
        df = df.withColumn(f"{out}_f_{kind}", F.coalesce(found, none))
    for kind, pattern in PATTERNS.items():
        df = df.withColumn(f"{out}_g_{kind}", F.when(
            F.size(f"{out}_f_{kind}") > 0, F.split(F.col(text), pattern, -1)))
    parts = []
    for k, kind in enumerate(PATTERNS):
        f, g = f"{out}_f_{kind}", f"{out}_g_{kind}"
        parts.append(f"""if(size({f}) = 0, cast(array() as array<{_SPAN}>), transform(filter(
            {_located(text, f, g)}, m -> {_valid(kind)}), m -> named_struct(
            'start', m.start, 'k', {k}, 'end', m.end, 'kind', '{kind}', 'value', m.value)))""")
    df = df.withColumn(out, F.expr(f"array_sort(concat({', '.join(parts)}))"))
    return df.drop(*[f"{out}_{x}_{kind}" for x in "fg" for kind in PATTERNS])


def found_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, key, spans) of every row; ``key`` is the text's hash, null without spans."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    rows = with_base(rows, "text", "spans")
    return rows.select("id", F.when(F.size("spans") > 0, _key("text")).alias("key"), "spans")


def _key(text: str) -> Column:
    return F.unhex(F.md5(F.col(text).cast("binary")))


def _keyed(docs: DataFrame, text_col: str) -> DataFrame:
    rows = docs.select(F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    return rows.select(_key("text").alias("key"), "text")


def _words(text: str) -> Column:
    """The distinct terms of a whole text."""
    every = F.array_distinct(F.regexp_extract_all(F.col(text), F.lit(TERM), F.lit(0)))
    return F.array_distinct(F.transform(every, F.lower))


def _terms(texts: DataFrame) -> DataFrame:
    """(key, ts): the distinct terms of every distinct text of ``texts`` (key, text).

    A text travels once, with all its terms: a row per term would carry the key with each.
    """
    return texts.select("key", _words("text").alias("ts")).groupBy("key").agg(F.first("ts").alias("ts"))


def mentions(found: DataFrame) -> DataFrame:
    """(key, c): the distinct entities of every row, a row each."""
    return found.filter("size(spans) > 0").select("key", F.explode(F.expr(
        "array_distinct(transform(spans, s -> concat(s.kind, ':', lower(s.value))))")).alias("c"))


def _beside(docs: DataFrame, found: DataFrame, entity: DataFrame, text_col: str) -> DataFrame:
    """(key, c, t): every term of every distinct text that mentions an entity of ``entity``."""
    asked = mentions(found).distinct().join(entity.select("c"), "c").select("key", "c").checkpoint(eager=True)
    texts = maybe_held(_keyed(docs, text_col), "key", asked.select("key"))
    return _terms(texts).join(asked, "key").select("key", "c", F.explode("ts").alias("t"))


def disclosure(docs: DataFrame, found: DataFrame, min_docs: int = MIN_DOCS,
               threshold: float = GENERALISE, text_col: str = "text") -> DataFrame:
    """(c, t, risk) of the terms that disclose ``threshold`` or more of an entity.

    All counts are of distinct texts: copies are no evidence.
    """
    # n_ct never exceeds n_c: entities in fewer texts have no such term.
    entity = (mentions(found).distinct().groupBy("c").agg(F.count(F.lit(1)).alias("n_c"))
              .filter(F.col("n_c") >= min_docs).checkpoint(eager=True))
    pairs = (_beside(docs, found, entity, text_col).groupBy("c", "t")
             .agg(F.count(F.lit(1)).alias("n_ct"))
             .filter(F.col("n_ct") >= min_docs).checkpoint(eager=True))
    terms = pairs.select("t").distinct().checkpoint(eager=True)
    words = _terms(_keyed(docs, text_col)).select(F.explode("ts").alias("t"))
    n_t = maybe_held(words, "t", terms).groupBy("t").agg(F.count(F.lit(1)).alias("n_t"))
    total = float(_keyed(docs, text_col).select("key").distinct().count())
    ic = F.log(F.lit(total) / F.col("n_c"))
    pmi = F.log(F.col("n_ct") * F.lit(total) / (F.col("n_c") * F.col("n_t")))
    return (pairs.join(entity, "c").join(n_t, "t")
            .withColumn("risk", F.round(F.when(ic > 0, pmi / ic).otherwise(0.0), 6))
            .filter(F.col("risk") >= threshold).select("c", "t", "risk"))


def term_spans(docs: DataFrame, found: DataFrame, risky: DataFrame,
               text_col: str = "text") -> DataFrame:
    """(key, term_spans) of the texts that hold a disclosing term of their entity: every
    place of the term outside the spans."""
    risky = risky.checkpoint(eager=True)
    asked = (_beside(docs, found, risky.select("c").distinct(), text_col)
             .join(risky, ["c", "t"])
             .groupBy("key", "t").agg(F.max("risk").alias("risk")).checkpoint(eager=True))
    held = asked.groupBy("key").agg(F.collect_list("t").alias("ts"),
                                    F.map_from_entries(F.collect_list(F.struct("t", "risk")))
                                    .alias("risks"))
    rows = maybe_held(_keyed(docs, text_col), "key", asked.select("key")).join(held, "key")
    rows = with_base(rows, "text", "spans")
    rows = (rows.withColumn("w", F.regexp_extract_all(F.col("text"), F.lit(TERM), F.lit(0)))
            .withColumn("g", F.split(F.col("text"), TERM, -1)))
    places = _walk("w", "g", "struct<start:bigint,end:bigint,t:string>", """named_struct(
        'start', a.at + length(g[i]), 'end', a.at + length(g[i]) + length(w[i]),
        't', lower(w[i]))""", "array_contains(ts, lower(w[i]))")
    spans = f"""transform(filter({places}, m ->
        not exists(spans, b -> b.start < m.end and m.start < b.end)),
        m -> named_struct('start', m.start, 'end', m.end, 'risk', risks[m.t]))"""
    # Equal texts have equal places: one row of each is enough. A filter on the places would
    # be pushed below, and evaluate the matches again for every word.
    return (rows.select("key", F.expr(spans).alias("term_spans")).groupBy("key").agg(F.first("term_spans").alias("term_spans")))


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans, term_spans) of every row."""
    checkpoint_root(docs.sparkSession)
    found = found_spans(docs, id_col, text_col).checkpoint(eager=True)
    terms = term_spans(docs, found, disclosure(docs, found, text_col=text_col), text_col)
    none = F.expr("cast(array() as array<struct<start:bigint,end:bigint,risk:double>>)")
    # Rows without spans have no key: they never meet in the join.
    plain = found.filter("key is null").select("id", "spans", none.alias("term_spans"))
    rest = (found.filter("key is not null").join(terms, "key", "left")
            .select("id", "spans", F.coalesce("term_spans", none).alias("term_spans")))
    return plain.unionByName(rest).withColumnRenamed("id", id_col)


def joined_spans(spans: str = "spans", terms: str | None = None) -> Column:
    """kind:start:end of all spans, by start, then kind (terms last), comma-joined."""
    every = f"transform({spans}, s -> struct(s.start as start, s.k as k, s.end as end, s.kind as kind))"
    if terms:
        every = f"""concat({every}, transform({terms}, s -> struct(
            s.start as start, {len(PATTERNS)} as k, s.end as end, 'term' as kind)))"""
    return F.expr(f"array_join(transform(array_sort({every}), "
                  "s -> concat(s.kind, ':', s.start, ':', s.end)), ',')")


def cleaned(text: str, spans: str, terms: str) -> Column:
    """The text with entities replaced by their kind and terms generalised or removed."""
    edits = f"""array_sort(concat(
        transform({spans}, s -> struct(s.start as start, s.k as k, s.end as end,
                                       concat('[', upper(s.kind), ']') as form)),
        transform({terms}, s -> struct(s.start as start, {len(PATTERNS)} as k, s.end as end,
                                       if(s.risk >= {REMOVE}, '', '[TERM]') as form))))"""
    return F.expr(f"""if(size({spans}) = 0, {text}, aggregate({edits},
        named_struct('at', 0L, 'out', ''),
        (a, e) -> if(e.start < a.at,
            named_struct('at', greatest(a.at, e.end), 'out', a.out),
            named_struct('at', e.end, 'out', concat(a.out, substring({text}, cast(a.at as int) + 1,
                         cast(e.start - a.at as int)), e.form))),
        a -> concat(a.out, substring({text}, cast(a.at as int) + 1, length({text})))))""")


def sanitise(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with sanitised texts, all rows and columns otherwise as they were."""
    checkpoint_root(docs.sparkSession)
    found = found_spans(docs, text_col, text_col).drop("id").checkpoint(eager=True)
    terms = term_spans(docs, found, disclosure(docs, found, text_col=text_col), text_col).checkpoint(eager=True)
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                         F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    packed = with_base(packed, "text", "spans")
    none = F.expr("cast(array() as array<struct<start:bigint,end:bigint,risk:double>>)")
    key = F.unhex(F.md5(F.col("text").cast("binary")))
    packed = packed.withColumn("key", key)
    # Rows without spans hold no term: they never meet in the join.
    plain = packed.filter("size(spans) = 0").withColumn("term_spans", none)
    joined = (packed.filter("size(spans) > 0").join(terms, "key", "left")
              .withColumn("term_spans", F.coalesce("term_spans", none)))
    joined = plain.unionByName(joined)
    clean = F.when(F.col(f"row.`{text_col}`").isNotNull(), cleaned("text", "spans", "term_spans"))
    return joined.select(*[(clean if c == text_col else F.col(f"row.`{c}`")).alias(c)
                           for c in docs.columns])
