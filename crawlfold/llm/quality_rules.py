"""Rules on the shape of a text, in SQL functions only.

Base rules count words, symbols, repeated lines and repeated windows. The divergence rule compares a
document's histograms, one of character classes and one of common words, with those of its language
over the whole corpus by Jensen-Shannon distance.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from crawlfold.session import written

#: Words are runs of anything but these.
WHITE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
#: Guards: a histogram of fewer characters or words says little, and is not judged.
MIN_CHARS_JUDGED = 200
MIN_WORDS_JUDGED = 50
#: Largest Jensen-Shannon distance (square root of the divergence in bits, 0 to 1) of a document that stays.
MAX_CLASS_DISTANCE = 0.18
MAX_WORD_DISTANCE = 0.33

#: A language needs so many documents for common words and references of its own.
MIN_DOCUMENTS = 100

# Frequent function words of some languages, in common order of frequency; those of others are counted.
COMMON = {
    "en": ("the", "of", "and", "to", "in", "a", "is", "that", "for", "it", "was", "on", "are", "as", "with"),
    "de": ("der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "für", "ist", "im"),
    "fr": ("de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est", "pour", "qui", "dans"),
    "es": ("de", "la", "que", "el", "en", "y", "a", "los", "del", "se", "las", "por", "un", "para", "con"),
}
#: Numbers and keys inside clean prose must not look odd, so digits count with the small letters.
CLASSES = ("small", "upper", "space", "stop", "symbol", "beyond")
N_COMMON = len(COMMON["en"])


def language(lang_col: str) -> Column:
    """The language of a code in small letters, without region: `EN`, `en-US` and `en_GB` are `en`; NULL if empty."""
    return F.nullif(F.regexp_extract(F.lower(F.trim(F.col(f"`{lang_col}`"))), "^[^-_]*", 0), F.lit(""))


def common_words(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> dict[str, tuple[str, ...]]:
    """`COMMON`, and the words most documents hold of every other language with enough documents.

    Languages are found from their column alone; texts are read only if there are others than those of `COMMON`.
    """
    lang = docs.select(language(lang_col).alias("lang"))
    others = [r["lang"] for r in lang.filter(~F.col("lang").isin(*COMMON)).groupBy("lang").count().filter(
        f"count >= {MIN_DOCUMENTS}").collect()]
    if not others:
        return dict(COMMON)
    words = docs.select(language(lang_col).alias("lang"), F.col(f"`{text_col}`").alias("text")).filter(F.col("lang").isin(others))
    words = words.select("lang", F.explode(F.array_distinct(F.split(F.lower("text"), WHITE))).alias("word"))
    counts = words.filter(F.col("word").rlike(r"^\p{L}+$")).groupBy("lang", "word").count()
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("count"), "word"))
    top = counts.withColumn("rank", rank).filter(F.col("rank") <= N_COMMON).groupBy("lang").agg(F.collect_list("word").alias("words"))
    return COMMON | {r["lang"]: tuple(r["words"]) for r in top.collect() if len(r["words"]) == N_COMMON}


def _gone(text: Column, pattern: str) -> Column:
    return F.regexp_replace(text, pattern, "")


def _held(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns behind a generator, which the optimizer does not merge into later expressions.

    Lambdas below use these columns once per element; merged, they would be computed anew each time.
    """
    values = F.struct(*[c.alias(n) for n, c in columns.items()])
    return df.select("*", F.inline(F.array(values)))


def _by_language(values: dict[str, list], lang_col: str) -> Column:
    """The list of the row's language, NULL without one."""
    if not values:
        return F.lit(None).cast("array<string>")
    table = F.create_map(*[x for k, v in values.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    return F.try_element_at(table, language(lang_col))


def histograms(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
               common: dict[str, tuple[str, ...]] = COMMON) -> DataFrame:
    """`docs` with `__text`, `__words`, `__n_words`, `__word_chars`, `__n_symbols`, `__class_n` (counts by
    `CLASSES`) and `__word_n` (counts of the language's common words, small or with a capital, then of all
    other words; NULL for a language without a list)."""
    df = _held(docs, __text=F.coalesce(F.col(f"`{text_col}`"), F.lit("")))
    df = _held(df, __words=F.filter(F.split("__text", WHITE), lambda w: w != ""),
               __no_lower=_gone(F.col("__text"), "[a-z]+"))
    forms = [f for words in common.values() for w in words for f in (w, w.capitalize())]
    df = _held(df, __rest=_gone(F.col("__no_lower"), WHITE),
               __common=F.transform(F.filter("__words", lambda w: w.isin(forms)), F.lower))
    df = _held(df, __signs=_gone(F.col("__rest"), r"[^\x00-\x7F]+"))
    size = F.length
    marks = _gone(F.col("__signs"), "[A-Z0-9]+")
    counts = {
        "upper": size("__signs") - size(_gone(F.col("__signs"), "[A-Z]+")),
        "small": size("__text") - size("__no_lower") + size("__signs") - size(_gone(F.col("__signs"), "[0-9]+")),
        "space": size("__no_lower") - size("__rest"),
        "symbol": size(_gone(marks, r"[.,;:'\"()?-]+")),
        "beyond": size("__rest") - size("__signs"),
    }
    counts["stop"] = size(marks) - counts["symbol"]
    df = _held(df, __own=_by_language(common, lang_col))
    per_lang = F.transform("__own", lambda w: F.size(F.filter("__common", lambda c: c == w)).cast("double"))
    df = _held(
        df,
        __n_words=F.size("__words").cast("long"),
        __word_chars=(size("__text") - counts["space"]).cast("long"),
        __n_symbols=size(_gone(marks, "[^" + SYMBOLS + "]+")).cast("long"),
        __class_n=F.array(*[counts[c].cast("double") for c in CLASSES]),
        __common_n=per_lang,
    )
    total = F.aggregate("__common_n", F.lit(0.0), lambda a, x: a + x)
    return df.withColumn("__word_n", F.concat("__common_n", F.array(F.col("__n_words") - total))).drop(
        "__no_lower", "__rest", "__signs", "__common", "__own", "__common_n")


def _judged(kind: str) -> Column:
    """The guards: enough characters, or words, for a histogram to say something."""
    if kind == "__class_n":
        return F.aggregate("__class_n", F.lit(0.0), lambda a, x: a + x) >= MIN_CHARS_JUDGED
    return F.col("__n_words") >= MIN_WORDS_JUDGED


def references(counted: DataFrame, lang_col: str = "lang") -> dict[str | None, dict[str, list]]:
    """Language -> its typical shares of the character classes and of the common words; None -> of all documents.

    A share is the median over all documents of the language that are long enough, so that junk, as
    long as it is the lesser part, does not move it; the medians are scaled to sum to one. One row per language
    of `COMMON`, or with `MIN_DOCUMENTS`, comes to the driver. If documents of no such language are left, the classes
    of the whole corpus are their reference.
    """
    def medians(kind: str, n: int) -> list[Column]:
        total = F.aggregate(kind, F.lit(0.0), lambda a, x: a + x)
        return [F.percentile_approx(F.when(_judged(kind), F.get(kind, i) / total), 0.5, 10_000).alias(f"{kind}{i}")
                for i in range(n)]

    classes = medians("__class_n", len(CLASSES))
    own = counted.groupBy(language(lang_col).alias("__lang")).agg(
        *classes, *medians("__word_n", N_COMMON + 1), F.count_if(_judged("__class_n")).alias("n"))
    rows = own.filter(F.col("__lang").isin(*COMMON) | (F.col("__lang").isNotNull() & (F.col("n") >= MIN_DOCUMENTS))).collect()
    rest = ~F.coalesce(language(lang_col).isin([r["__lang"] for r in rows]), F.lit(False))
    if not counted.filter(rest).isEmpty():
        rows += counted.agg(F.lit(None).alias("__lang"), *classes).collect()
    out: dict[str | None, dict[str, list]] = {}
    for row in rows:
        for kind in ("__class_n", "__word_n"):
            shares = [v for k, v in row.asDict().items() if k.startswith(kind)]
            if shares and None not in shares and sum(shares) > 0:
                out.setdefault(row["__lang"], {})[kind] = [x / sum(shares) for x in shares]
    return out


def distance(counts: Column, shares: Column) -> Column:
    """Jensen-Shannon distance between a histogram's shares and given shares; NULL without counts."""
    total = F.aggregate(counts, F.lit(0.0), lambda a, x: a + x)

    def term(c: Column, q: Column) -> Column:
        p = c / total
        m = (p + q) / 2
        return F.when(p > 0, p * F.log2(p / m)).otherwise(0.0) + F.when(q > 0, q * F.log2(q / m)).otherwise(0.0)

    divergence = F.aggregate(F.zip_with(counts, shares, term), F.lit(0.0), lambda a, x: a + x) / 2
    return F.when(total > 0, F.sqrt(F.greatest(divergence, F.lit(0.0))))


def _repeats(df: DataFrame) -> DataFrame:
    """Add `__n_repeat_words`: words inside a window of `WINDOW` words that stands in the text twice or more.

    Windows are compared by a 64-bit hash within the text, doubled from one word to eight.
    """
    df = _held(df, __hashes=F.when(F.size("__words") > WINDOW, F.transform("__words", lambda w: F.xxhash64(w))))
    for step in (1, 2, 4):
        later = F.slice("__hashes", F.lit(step + 1), F.greatest(F.size("__hashes") - step, F.lit(0)))
        both = F.zip_with("__hashes", later, lambda a, b: F.xxhash64(a, b))
        held = _held(df, __next=F.slice(both, F.lit(1), F.greatest(F.size("__hashes") - step, F.lit(0))))
        df = held.drop("__hashes").withColumnRenamed("__next", "__hashes")
    several = F.size(F.array_distinct("__hashes")) < F.size("__hashes")
    ordered = F.array_sort(F.transform("__hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    df = _held(df, __sorted=F.when(several, ordered))
    with_next = F.zip_with("__sorted", F.slice("__sorted", F.lit(2), F.size("__sorted")),
                           lambda a, b: F.coalesce(a["h"] == b["h"], F.lit(False)))
    df = _held(df, __same=with_next)
    marked = F.zip_with(
        F.zip_with("__sorted", "__same", lambda a, s: F.struct(a["i"].alias("i"), s.alias("s"))),
        F.concat(F.array(F.lit(False)), F.slice("__same", F.lit(1), F.size("__same") - 1)),
        lambda a, t: F.struct(a["i"].alias("i"), (a["s"] | t).alias("s")),
    )
    df = _held(df, __places=F.array_sort(F.transform(F.filter(marked, lambda a: a["s"]), lambda a: a["i"])))
    new = F.zip_with("__places", F.slice("__places", F.lit(2), F.size("__places")),
                     lambda a, b: F.least(F.lit(WINDOW), F.coalesce(b - a, F.lit(WINDOW))))
    count = F.aggregate(new, F.lit(0), lambda a, x: a + x)
    return df.withColumn("__n_repeat_words", F.coalesce(count, F.lit(0)).cast("long")).drop(
        "__hashes", "__sorted", "__same", "__places")


def count(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
          common: dict[str, tuple[str, ...]] = COMMON) -> DataFrame:
    """The columns of `docs` and `__n_words`, `__word_chars`, `__n_symbols`, `__n_dup_lines`,
    `__n_repeat_words` and the histograms `__class_n` and `__word_n`; one pass, no shuffle."""
    df = _repeats(histograms(docs, text_col, lang_col, common))
    lines = F.filter(F.split("__text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    df = _held(df, __lines=lines)
    repeated = F.size("__lines") - F.size(F.array_distinct("__lines"))
    return df.withColumn("__n_dup_lines", repeated.cast("long")).drop("__text", "__words", "__lines")


def judge(counted: DataFrame, shares: dict[str, dict[str, list]], lang_col: str = "lang") -> DataFrame:
    """Counted documents and `__class_distance`, `__word_distance`, `__base_failed`, `__kept`.

    A document fails the base rules with under `MIN_WORDS` words or with over `MAX_REPEAT_PERCENT` percent
    of its words in repeated windows. It fails the divergence rule if its language has a reference and a
    histogram with enough counts (the guards above) is farther from it than allowed. A rare language, or NULL,
    is held against the classes of the whole corpus, by stops, symbols and all else if over a quarter of the text is
    beyond ASCII, as other scripts have other letters and spaces; its words are not judged. NULL and empty texts have no words and fail the
    base rules. Each row is judged alone, so repeated rows agree; an empty table has no references.
    """

    def share(kind: str) -> Column:
        return _by_language({k: v[kind] for k, v in shares.items() if k is not None and kind in v}, lang_col).cast("array<double>")

    far_classes = distance(F.col("__class_n"), share("__class_n"))
    whole = shares.get(None, {}).get("__class_n")
    if whole:
        def folded(x) -> list:
            return [x[0] + x[1] + x[2] + x[5], x[3], x[4]]  # in the order of CLASSES

        own = [F.get("__class_n", i) for i in range(len(CLASSES))]
        corpus = F.when(4 * own[5] > sum(own[:5], own[5]), distance(F.array(*folded(own)), F.array(*map(F.lit, folded(whole))))).otherwise(
            distance(F.col("__class_n"), F.array(*map(F.lit, whole))))
        far_classes = F.when(share("__class_n").isNull(), corpus).otherwise(far_classes)
    df = _held(
        counted,
        __class_distance=far_classes,
        __word_distance=distance(F.col("__word_n"), share("__word_n")),
        __base_failed=(F.col("__n_words") < MIN_WORDS)
        | (100 * F.col("__n_repeat_words") > MAX_REPEAT_PERCENT * F.col("__n_words")),
    )
    far = (F.coalesce(_judged("__class_n") & (F.col("__class_distance") > MAX_CLASS_DISTANCE), F.lit(False))
           | F.coalesce(_judged("__word_n") & (F.col("__word_distance") > MAX_WORD_DISTANCE), F.lit(False)))
    return df.withColumn("__kept", ~F.col("__base_failed") & ~far)


def keep_good(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The documents that pass, with their own columns, whatever they are called.

    Texts are counted once and stored with their counts; references and verdicts come from what is stored.
    """
    rest = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns) if c != text_col]
    held = docs.select(F.struct(F.lit(0).alias("none"), *rest).alias("__row"), F.col(f"`{text_col}`").alias("text"), F.col(f"`{lang_col}`").alias("lang"))
    counted = written(count(held, common=common_words(held)))
    own = [F.col("text" if c == text_col else f"__row.c{i}").alias(c) for i, c in enumerate(docs.columns)]
    return judge(counted, references(counted)).filter("__kept").select(*own)


def op6_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang")
    counted = written(count(docs, common=common_words(docs)).drop("text"))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return judge(counted, references(counted)).select(
        "doc_id", *[F.col(f"__{n}").alias(n) for n in names])


def _sql_lists() -> str:
    lists = ", ".join(f"('{lang}', [{', '.join(repr(w) for w in words)}])" for lang, words in COMMON.items())
    return f"fixed(lang, common) as (values {lists})"


def _sql_distance(counts: str, shares: str) -> str:
    pairs = f"list_zip({counts}, {shares})"
    p, q = f"(x[1] / list_sum({counts}))", "x[2]"
    m = f"(({p} + {q}) / 2)"
    term = f"(case when {p} > 0 then {p} * log2({p} / {m}) else 0 end + case when {q} > 0 then {q} * log2({q} / {m}) else 0 end)"
    return f"sqrt(greatest(list_sum(list_transform({pairs}, lambda x: {term})) / 2, 0))"


def _sql_folded(x: str) -> str:
    """Stops, symbols and all else, in the order of the classes: other scripts have other letters and spaces."""
    return f"[{x}[1] + {x}[2] + {x}[3] + {x}[6], {x}[4], {x}[5]]"


def _sql_shares(counts: str, n: int, judged: str) -> str:
    """Per language the medians of each share, scaled to sum to one."""
    medians = ", ".join(f"quantile_disc(case when {judged} then {counts}[{i}] / list_sum({counts}) end, 0.5)" for i in range(1, n + 1))
    return f"[{medians}]"


SQL = rf"""
with {_sql_lists()},
d as (select doc_id, nullif(regexp_extract(lower(trim(lang)), '^[^-_]*'), '') as lang, coalesce(text, '') as t from documents),
-- Common words of the other languages with enough documents, by the documents that hold them.
counted as (
  select lang, word, count(*) as n
  from (select lang, unnest(list_distinct(regexp_split_to_array(lower(t), '[\x20\x09-\x0D]+'))) as word from d
        where lang in (select lang from d where lang not in (select lang from fixed) group by lang having count(*) >= {MIN_DOCUMENTS}))
  where regexp_full_match(word, '\p{{L}}+') group by lang, word),
lists as (
  select * from fixed union all
  select lang, list(word order by n desc, word)[1:{N_COMMON}] from counted group by lang having count(*) >= {N_COMMON}),
w as (select *, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from d),
win as (
  select doc_id, i, array_to_string(w[i:i+{WINDOW - 1}], ' ') as g
  from (select doc_id, w, unnest(range(1, len(w) - {WINDOW - 2})) as i from w where len(w) >= {WINDOW})),
again as (select doc_id, i, count(*) over (partition by doc_id, g) as n from win),
rep as (select doc_id, count(distinct k) as n from (select doc_id, unnest(range(i, i + {WINDOW})) as k from again where n > 1) group by doc_id),
c as (
  select w.doc_id, w.lang, t, len(w)::bigint as n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::bigint as word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols,
    (len(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))
     - len(list_distinct(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))))::bigint as n_dup_lines,
    coalesce(rep.n, 0)::bigint as n_repeat_words,
    regexp_replace(t, '[a-zA-Z0-9\x20\x09-\x0D]|[^\x00-\x7F]', '', 'g') as marks,
    [length(regexp_replace(t, '[^a-z0-9]', '', 'g')), length(regexp_replace(t, '[^A-Z]', '', 'g')),
     length(regexp_replace(t, '[^\x20\x09-\x0D]', '', 'g')), length(regexp_replace(t, '[\x00-\x7F]', '', 'g'))] as four,
    case when common is not null then list_transform(common, lambda x: len(list_filter(w, lambda y: y = x or y = upper(x[1]) || x[2:]))) end as found
  from w left join rep using (doc_id) left join lists on lists.lang = w.lang),
k as (
  select *, list_transform([four[1], four[2], four[3], length(marks) - length(regexp_replace(marks, '[.,;:''"()?-]', '', 'g')),
      length(regexp_replace(marks, '[.,;:''"()?-]', '', 'g')), four[4]], lambda x: x::double) as cn,
    case when found is not null then list_transform(list_append(found, n_words - list_sum(found)), lambda x: x::double) end as wn
  from c),
ref as (
  select lang, {_sql_shares('cn', len(CLASSES), f'list_sum(cn) >= {MIN_CHARS_JUDGED}')} as cm,
    {_sql_shares('wn', len(COMMON['en']) + 1, f'n_words >= {MIN_WORDS_JUDGED}')} as wm
  from k where lang is not null group by lang
  having lang in (select lang from fixed) or count(*) filter (where list_sum(cn) >= {MIN_CHARS_JUDGED}) >= {MIN_DOCUMENTS}),
-- The whole corpus stands for languages without a reference of their own, if there are any.
corpus as (
  select list_transform(cm, lambda x: x / list_sum(cm)) as whole
  from (select {_sql_shares('cn', len(CLASSES), f'list_sum(cn) >= {MIN_CHARS_JUDGED}')} as cm from k)
  where exists (select 1 from k where lang is null or lang not in (select lang from ref)) and list_sum(cm) > 0),
scaled as (
  select lang, case when list_sum(cm) > 0 and len(list_filter(cm, lambda x: x is null)) = 0 then list_transform(cm, lambda x: x / list_sum(cm)) end as cs,
    case when list_sum(wm) > 0 and len(list_filter(wm, lambda x: x is null)) = 0 then list_transform(wm, lambda x: x / list_sum(wm)) end as ws
  from ref),
v as (
  select k.*, n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words as base_failed,
    case when list_sum(cn) < {MIN_CHARS_JUDGED} then null when cs is not null then {_sql_distance('cn', 'cs')}
         when whole is null then null when 4 * cn[6] > list_sum(cn) then {_sql_distance(_sql_folded('cn'), _sql_folded('whole'))}
         else {_sql_distance('cn', 'whole')} end as cd,
    case when n_words >= {MIN_WORDS_JUDGED} and ws is not null and wn is not null then {_sql_distance('wn', 'ws')} end as wd
  from k left join scaled on scaled.lang = k.lang left join corpus on true)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and not coalesce(cd > {MAX_CLASS_DISTANCE}, false) and not coalesce(wd > {MAX_WORD_DISTANCE}, false) as kept
from v
"""
