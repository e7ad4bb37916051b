r"""Benchmark decontamination by template canonicalisation.

Both sides are rewritten to typed templates: numbers, units next to numbers (and
currency signs), and names (capitalised words inside a sentence) become placeholders,
everything else is lower-cased, punctuation goes.  Windows of ``window`` canonical
tokens are hashed and the corpus' windows are joined with the benchmark's by hash, so
a question whose numbers or names were replaced still meets its original.  A
placeholder keeps its original string as a slot value: within a document and item, an
item's slot value must always be replaced by the same value, and windows that break
that are dropped; the value that counts is the one at the shift (document position
less item position) with most matched windows, then the most frequent one.

Names are told by their capitals, so a copy in other case has other templates.  Both
sides are therefore read in two forms: ``TYPED`` as above, and ``PLAIN`` with names left
as lower-cased words.  A document is also contaminated when the share reaches ``coverage``
with each typed window counted that is left in the typed form or whose plain window,
the one that starts at the same letter, is; or when that share of the item's plain
windows is left.  The figures reported are the first of the three that suffice.

Only DataFrame and SQL functions run.  The benchmark's windows are broadcast only if
counted at ``BROADCAST_WINDOWS`` or fewer; beyond that the join shuffles.

Defined results: null or empty texts have no windows; benchmark windows with fewer
than ``literal`` tokens that are no placeholder are no evidence and are left out; an
item that has no other window in either form (short questions, rows of numbers) is
searched word for word, case ignored, by its windows of plain tokens with their slot
values, which are as long as the item if that is shorter, so an item of one word meets
every document with that word; an item without any token never matches; repeated benchmark rows count once, and different
texts under one item id are searched one by one (told apart by a 64-bit hash), of which
the one with the greatest share is reported; repeated document rows with one id count as
one document (windows found in any); rows whose id is null are not reported; extra
columns are not read.  ``drop_contaminated`` decides each row by its own text, whatever
its id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskframe.llm._common import cut, file_backed, hold, located, only_at, pick, table

WINDOW, LITERAL, COVERAGE = 5, 3, 0.6
#: Rows of (hash, item, position, slots), about 100 bytes each, up to which they are broadcast.
BROADCAST_WINDOWS = 300_000
#: The forms a text is read in, as positions in ``_forms``; a text without names is read once, as both.
TYPED, PLAIN, BOTH = 0, 1, 2
#: What tells one benchmark text from another.
ITEM = ["item_id", "item_text"]
#: What is counted, in the order of the report: typed windows, typed windows matched in either form, plain windows.
BY_TYPED, BY_EITHER, BY_PLAIN = 0, 1, 2

#: Unit names that may follow a number.
UNITS = ("km", "cm", "mm", "m", "mi", "ft", "kg", "g", "mg", "lb", "oz", "l", "ml", "s", "ms", "min", "h", "hours", "minutes",
         "seconds", "days", "weeks", "months", "years", "meters", "metres", "miles", "feet", "grams", "liters", "litres",
         "dollars", "euros", "cents", "percent", "degrees", "usd", "eur", "gbp", "kb", "mb", "gb", "tb", "w", "kw", "v", "hz")
# Placeholders: number, unit, name; the last one ends a slot value.
NUM, UNIT, NAME, END = (chr(c) for c in (0xE000, 0xE001, 0xE002, 0xE003))
RESERVED = f"[{NUM}{UNIT}{NAME}{END}]"
#: Possessive, which matches the same since nothing follows the repetitions: a plain repeated group takes a
#: stack frame a turn, and a text of some thousand capitalised words or joined numbers ends the JVM's stack.
NUMBERS = r"[0-9]++(?:[.,:][0-9]++)*+"
UNIT_WORDS = rf"({END} ?)((?i:{'|'.join(sorted(UNITS, key=lambda u: (-len(u), u)))})\b|[%°])"
SIGNS = r"[$€£¥]"
NAMES = r"([\p{Ll}\p{Nd},;:] )(\p{Lu}\p{L}++(?:['-]\p{L}++)*+(?: \p{Lu}\p{L}++(?:['-]\p{L}++)*+)*+)"
#: Where a name begins; texts without one have the same tokens in both forms.
NAME_START = r"[\p{Ll}\p{Nd},;:] \p{Lu}\p{L}"
TOKENS = rf"[{NUM}{UNIT}{NAME}][^{END}]*|[\p{{L}}\p{{Nd}}]+"


def _tokens(text, names: bool = True):
    """Lower-cased canonical tokens; a placeholder is followed by its slot value."""
    t = F.regexp_replace(F.coalesce(text, F.lit("")), RESERVED, " ")
    t = F.regexp_replace(t, NAMES, f"$1{NAME}$2{END}") if names else t
    t = F.regexp_replace(t, NUMBERS, f"{NUM}$0{END}")
    t = F.regexp_replace(t, UNIT_WORDS, f"$1{UNIT}$2{END}")
    t = F.regexp_replace(t, SIGNS, f"{UNIT}$0{END}")
    return F.regexp_extract_all(F.lower(t), F.lit(TOKENS), F.lit(0))


def _forms(text):
    return F.array(_tokens(text), _tokens(text, names=False))


def _slot(token):
    return (token >= F.lit(NUM)) & (token < F.lit(END))


def _canon(tokens: str):
    """The tokens with placeholders in place of slot values."""
    return F.when(F.exists(tokens, _slot), F.transform(tokens, lambda t: F.when(_slot(t), F.substring(t, 1, 1)).otherwise(t))).otherwise(F.col(tokens))


def _hash(canon: str, i, window: int):
    return F.xxhash64(*[F.get(canon, i + j) for j in range(window)])


def _slots(tokens: str, i, window: int):
    return F.filter(F.slice(tokens, i + 1, window), _slot)


def _slots_in_join(tokens: str, i, window: int):
    """``_slots`` without a lambda: it is generated into the join's own code, so what leaves the join is the
    slot values.  A lambda is evaluated after it, on rows that each hold a copy of the document's tokens."""
    none, token = F.array().cast("array<string>"), lambda j: F.get(tokens, i + j)
    return F.concat(*[F.when(_slot(token(j)), F.array(token(j))).otherwise(none) for j in range(window)])


def _windows(df: DataFrame, keys: list[str], window: int) -> DataFrame:
    """(keys, form, pos, h, slots, first): every window of canonical tokens of both forms, slots null
    where it has none; ``first`` is its first token."""
    df = df.select(*keys, F.posexplode(_forms(F.col("text"))).alias("form", "tokens")).filter(F.size("tokens") >= window)
    df = hold(df.withColumn("canon", F.lit(None)), "canon", _canon("tokens"))
    one = lambda i: F.struct(_hash("canon", i, window).alias("h"), _slots("tokens", i, window).alias("slots"), F.get("tokens", i).alias("first"))
    windows = F.transform(F.sequence(F.lit(0), F.size("tokens") - window), one)
    out = df.select(*keys, "form", F.posexplode(windows).alias("pos", "w")).select(*keys, "form", "pos", "w.h", "w.slots", "w.first")
    return out.withColumn("slots", F.when(F.size("slots") > 0, F.col("slots")))


def _found(docs: DataFrame, keys: list[str], right: DataFrame, window: int) -> DataFrame:
    """The windows of ``docs`` that ``right`` has, (keys, pos, slots and right's columns).

    Hashes alone are spread to rows.  Where ``right`` is broadcast, the windows that stay fetch their slot
    values from the tokens beside them, inside the join: all windows of a document that match leave it before
    the first is taken up, so a copy of the tokens in each would need the square of the document's length.
    Where ``right`` is not broadcast, the values go with the hash."""
    few = right.count() <= BROADCAST_WINDOWS
    right = F.broadcast(right) if few else right
    docs = hold(docs.select(*keys, "text"), "text", F.regexp_replace(F.coalesce("text", F.lit("")), RESERVED, " "))
    read = lambda form, names: F.struct(F.lit(form).alias("read_as"), _tokens(F.col("text"), names).alias("tokens"))
    forms = F.when(F.col("text").rlike(NAME_START), F.array(read(TYPED, True), read(PLAIN, False))).otherwise(F.array(read(BOTH, False)))
    docs = docs.select(*keys, F.explode(forms).alias("f")).select(*keys, "f.*").filter(F.size("tokens") >= window)
    docs = hold(docs.withColumn("canon", F.lit(None)), "canon", _canon("tokens"))
    at = F.sequence(F.lit(0), F.size("tokens") - window)
    same = F.col("read_as").isin(BOTH) | (F.col("read_as") == F.col("form"))
    if few:
        rows = hold(docs, "hs", F.transform(at, lambda i: _hash("canon", i, window)))
        rows = rows.select(*keys, "read_as", "tokens", F.posexplode("hs").alias("pos", "h"))
        found = rows.join(right, "h").filter(same).withColumn("slots", _slots_in_join("tokens", F.col("pos"), window))
    else:
        each = F.transform(at, lambda i: F.struct(_hash("canon", i, window).alias("h"), _slots("tokens", i, window).alias("slots")))
        rows = docs.select(*keys, "read_as", F.posexplode(each).alias("pos", "w")).select(*keys, "read_as", "pos", "w.*")
        found = rows.join(right, "h").filter(same)
    return found.drop("tokens", "read_as").withColumn("slots", F.when(F.size("slots") > 0, F.col("slots")))


def _item_windows(items: DataFrame, window: int, literal: int) -> DataFrame:
    """The items' windows that are evidence, (ITEM, form, item_pos, typed_pos, h, item_slots): ``typed_pos``
    is the typed window that starts where a plain one does.  Both forms hold the same letters and
    digits, so a place is how many of them lie before it."""
    letters = F.length(F.regexp_replace("first", r"[^\p{L}\p{Nd}]", ""))
    before = F.sum(letters).over(Window.partitionBy(*ITEM, "form").orderBy("pos")) - letters
    w = _windows(items, ITEM, window).withColumn("place", 2 * before + F.when(letters > 0, 1).otherwise(0))
    w = cut(w.filter(F.coalesce(F.size("slots"), F.lit(0)) <= window - literal)
            .select(*ITEM, "form", F.col("pos").alias("item_pos"), "place", "h", F.col("slots").alias("item_slots")))
    typed = w.filter(F.col("form") == TYPED).groupBy(*ITEM, "place").agg(F.min("item_pos").alias("typed_pos"))
    typed = typed.withColumn("form", F.lit(PLAIN))
    return cut(w.join(typed, [*ITEM, "form", "place"], "left").drop("place"))


def _exact(docs: DataFrame, items: DataFrame, keys: list[str], window: int) -> DataFrame | None:
    """(keys, ITEM, n_windows, n_matched): documents with windows of the items' own tokens and slot
    values; None if no item has a token."""
    def windows(df: DataFrame, names: list[str], sizes: list[int], fits) -> DataFrame:
        one = lambda n: lambda i: F.xxhash64(F.lit(n), *[F.get("tokens", i + j) for j in range(n)])
        by_size = [F.when(fits(n), F.transform(F.sequence(F.lit(0), F.size("tokens") - n), one(n))).otherwise(F.array().cast("array<bigint>"))
                   for n in sizes]
        return df.select(*names, F.posexplode(F.flatten(F.array(*by_size))).alias("pos", "h"))

    read = lambda df, names: hold(df, "tokens", _tokens(F.col("text"), names=False)).select(*names, "tokens").filter(F.size("tokens") > 0)
    items = cut(read(items, ITEM).withColumn("n", F.least(F.size("tokens"), F.lit(window))))
    sizes = sorted(r["n"] for r in items.select("n").distinct().collect())
    if not sizes:
        return None
    right = cut(windows(items, ITEM, sizes, lambda n: F.col("n") == n).withColumnRenamed("pos", "item_pos"))
    totals = right.groupBy(*ITEM).agg(F.count("*").alias("n_windows"))
    right = F.broadcast(right) if right.count() <= BROADCAST_WINDOWS else right
    found = windows(read(docs, keys), keys, sizes, lambda n: F.size("tokens") >= n).join(right, "h")
    matched = found.groupBy(*keys, *ITEM).agg(F.count_distinct("item_pos").alias("n_matched"))
    return matched.join(totals, ITEM)


def _leaks(docs: DataFrame, keys: list[str], bench: DataFrame, window: int, literal: int, coverage: float) -> DataFrame:
    """(keys, item_id, n_windows, n_matched, share) of ``docs`` (keys, text)."""
    items = pick(bench, "item_id", "text").filter("item_id is not null").distinct().withColumn("item_text", F.xxhash64("text"))
    right = _item_windows(items, window, literal)
    totals = (right.withColumn("by", F.explode(F.when(F.col("form") == TYPED, F.array(F.lit(BY_TYPED), F.lit(BY_EITHER))).otherwise(F.array(F.lit(BY_PLAIN)))))
              .groupBy(*ITEM, "by").agg(F.count("*").alias("n_windows")))
    exact = _exact(docs, items.join(right.select(*ITEM).distinct(), ITEM, "left_anti"), keys, window)
    found = _found(docs, keys, right, window).withColumn("shift", F.col("pos") - F.col("item_pos"))
    # one row per document, item, form, item window, shift and slot values: repeats go before anything moves
    found = cut(found.groupBy(*keys, *ITEM, "form", "item_pos", "typed_pos", "shift", "item_slots", "slots").agg(F.count("*").alias("times")))
    pair = [*keys, *ITEM, "form"]
    along = found.groupBy(*pair, "shift").agg(F.count_distinct("item_pos").alias("along"))
    pairs = (found.filter("slots is not null").join(along, [*pair, "shift"])
             .select(*pair, "times", "along", F.explode(F.arrays_zip("item_slots", "slots")).alias("z"))
             .groupBy(*pair, F.col("z.item_slots").alias("item_slot"), F.col("z.slots").alias("slot"))
             .agg(F.max("along").alias("along"), F.sum("times").alias("times")))
    chosen = (pairs.groupBy(*pair, "item_slot").agg(F.max_by("slot", F.struct("along", "times", "slot")).alias("slot"))
              .groupBy(*pair).agg(F.map_from_entries(F.collect_list(F.struct("item_slot", "slot"))).alias("replaced")))
    checked = found.join(chosen, pair, "left").filter(
        F.col("slots").isNull() | F.forall(F.arrays_zip("item_slots", "slots"), lambda z: F.element_at("replaced", z["item_slots"]) == z["slots"]))
    count = lambda by, at: F.struct(F.lit(by).alias("by"), F.col(at).alias("at"))
    counted = F.when(F.col("form") == TYPED, F.array(count(BY_TYPED, "item_pos"), count(BY_EITHER, "item_pos"))).otherwise(
        F.array(count(BY_EITHER, "typed_pos"), count(BY_PLAIN, "item_pos")))
    matched = (checked.select(*keys, *ITEM, F.explode(counted).alias("c")).filter("c.at is not null")
               .groupBy(*keys, *ITEM, "c.by").agg(F.count_distinct("c.at").alias("n_matched")))
    shares = (matched.join(totals, [*ITEM, "by"]).withColumn("share", F.col("n_matched") / F.col("n_windows"))
              .filter(F.col("share") >= coverage))
    best = shares.groupBy(*keys, *ITEM).agg(F.min_by(F.struct("share", "n_windows", "n_matched"), "by").alias("s"))
    if exact is not None:
        exact = exact.withColumn("s", F.struct((F.col("n_matched") / F.col("n_windows")).alias("share"), "n_windows", "n_matched"))
        best = best.unionByName(exact.select(*keys, *ITEM, "s").filter(F.col("s.share") >= coverage))
    best = best.groupBy(*keys, "item_id").agg(F.max("s").alias("s"))
    return best.select(*keys, "item_id", "s.n_windows", "s.n_matched", "s.share")


def leaks(docs: DataFrame, bench: DataFrame, window: int = WINDOW, literal: int = LITERAL, coverage: float = COVERAGE) -> DataFrame:
    """(doc_id, item_id, n_windows, n_matched, share): the contaminated pairs."""
    return _leaks(pick(docs, "doc_id", "text").filter("doc_id is not null"), ["doc_id"], bench, window, literal, coverage)


def drop_contaminated(docs: DataFrame, bench: DataFrame) -> DataFrame:
    """The rows of ``docs`` that no item contaminates, with all their columns."""
    docs = file_backed(docs)
    bad = _leaks(located(pick(docs, "text")), ["_path", "_row"], bench, WINDOW, LITERAL, COVERAGE).select("_path", "_row").distinct()
    return only_at(docs, bad, "left_anti")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _sql() -> str:
    """The operator's rules, windows compared as lists.  The patterns are spelt without possessive marks."""
    names, numbers = (p.replace("++", "+").replace("*+", "*").replace("'", "''") for p in (NAMES, NUMBERS))
    slot = f"(x >= '{NUM}' AND x < '{END}')"

    def tokens(form: int) -> str:
        t = f"regexp_replace(coalesce(text, ''), '{RESERVED}', ' ', 'g')"
        t = f"regexp_replace({t}, '{names}', '\\1{NAME}\\2{END}', 'g')" if form == TYPED else t
        t = f"regexp_replace({t}, '{numbers}', '{NUM}\\0{END}', 'g')"
        t = f"regexp_replace({t}, '{UNIT_WORDS}', '\\1{UNIT}\\2{END}', 'g')"
        t = f"regexp_replace({t}, '{SIGNS}', '{UNIT}\\0{END}', 'g')"
        return f"regexp_extract_all(lower({t}), '{TOKENS}')"

    def windows(source: str, keys: str) -> str:
        of = lambda form: (
            f"SELECT {keys}, {form} AS form, tokens, unnest(range(0, len(tokens) - {WINDOW} + 1)) AS pos FROM (SELECT {keys}, {tokens(form)} AS tokens FROM {source})")
        return f"""SELECT {keys}, form, pos, tokens[pos + 1] AS head, list_transform(w, lambda x: CASE WHEN {slot} THEN x[1] ELSE x END) AS canon,
            list_filter(w, lambda x: {slot}) AS slots
        FROM (SELECT *, list_slice(tokens, pos + 1, pos + {WINDOW}) AS w FROM ({of(TYPED)} UNION ALL {of(PLAIN)}))"""

    pair, letters = "doc_id, item_id, item_text, form", "length(regexp_replace(head, '[^\\p{L}\\p{Nd}]', '', 'g'))"
    return f"""
WITH docs AS (SELECT doc_id, text FROM documents WHERE doc_id IS NOT NULL),
items AS (SELECT DISTINCT item_id, coalesce(text, '') AS text, coalesce(text, '') AS item_text FROM benchmark WHERE item_id IS NOT NULL),
placed AS (
  SELECT *, 2 * (sum({letters}) OVER (PARTITION BY item_id, item_text, form ORDER BY pos) - {letters}) + CASE WHEN {letters} > 0 THEN 1 ELSE 0 END AS place
  FROM ({windows('items', 'item_id, item_text')})),
evidence AS (SELECT * FROM placed WHERE len(slots) <= {WINDOW - LITERAL}),
typed AS (SELECT item_id, item_text, place, min(pos) AS typed_pos FROM evidence WHERE form = {TYPED} GROUP BY ALL),
bench AS MATERIALIZED (
  SELECT e.item_id, e.item_text, form, pos AS item_pos, CASE WHEN form = {PLAIN} THEN typed_pos END AS typed_pos, canon, slots AS item_slots
  FROM evidence e LEFT JOIN typed USING (item_id, item_text, place)),
totals AS (
  SELECT item_id, item_text, unnest(CASE WHEN form = {TYPED} THEN [{BY_TYPED}, {BY_EITHER}] ELSE [{BY_PLAIN}] END) AS counted, count(*) AS n_windows
  FROM bench GROUP BY item_id, item_text, form),
found AS MATERIALIZED (
  SELECT d.doc_id, b.item_id, b.item_text, form, b.item_pos, b.typed_pos, d.pos - b.item_pos AS shift, b.item_slots, d.slots, count(*) AS times
  FROM ({windows('docs', 'doc_id')}) d JOIN bench b USING (form, canon) GROUP BY ALL),
along AS (SELECT {pair}, shift, count(DISTINCT item_pos) AS along FROM found GROUP BY ALL),
spread AS (
  SELECT {pair}, item_pos, slots, times, shift, unnest(item_slots) AS item_slot, unnest(slots) AS slot FROM found),
pairs AS (SELECT {pair}, item_slot, slot, max(along) AS along, sum(times) AS times FROM spread JOIN along USING ({pair}, shift) GROUP BY ALL),
chosen AS (
  SELECT {pair}, item_slot, slot FROM pairs
  QUALIFY row_number() OVER (PARTITION BY {pair}, item_slot ORDER BY along DESC, times DESC, slot DESC) = 1),
broken AS (
  SELECT DISTINCT {pair}, s.item_pos, s.slots, s.shift FROM spread s JOIN chosen c USING ({pair}, item_slot) WHERE s.slot <> c.slot),
checked AS (SELECT f.* FROM found f ANTI JOIN broken b USING ({pair}, item_pos, slots, shift)),
places AS (
  SELECT doc_id, item_id, item_text, unnest(CASE WHEN form = {TYPED} THEN [{BY_TYPED}, {BY_EITHER}] ELSE [{BY_EITHER}, {BY_PLAIN}] END) AS counted,
         unnest(CASE WHEN form = {TYPED} THEN [item_pos, item_pos] ELSE [typed_pos, item_pos] END) AS at_pos FROM checked),
matched AS (SELECT doc_id, item_id, item_text, counted, count(DISTINCT at_pos) AS n_matched FROM places WHERE at_pos IS NOT NULL GROUP BY ALL),
by_evidence AS (
  SELECT doc_id, item_id, n_windows, n_matched, n_matched / n_windows AS share FROM matched JOIN totals USING (item_id, item_text, counted)
  WHERE n_matched / n_windows >= {COVERAGE}
  QUALIFY row_number() OVER (PARTITION BY doc_id, item_id, item_text ORDER BY counted) = 1),
short AS (
  SELECT item_id, item_text, tokens, least(len(tokens), {WINDOW}) AS n FROM (SELECT item_id, item_text, {tokens(PLAIN)} AS tokens FROM items)
  ANTI JOIN bench USING (item_id, item_text) WHERE len(tokens) > 0),
short_windows AS (
  SELECT item_id, item_text, n, item_pos, list_slice(tokens, item_pos + 1, item_pos + n) AS w
  FROM (SELECT *, unnest(range(0, len(tokens) - n + 1)) AS item_pos FROM short)),
doc_windows AS (
  SELECT doc_id, n, list_slice(tokens, pos + 1, pos + n) AS w
  FROM (SELECT *, unnest(range(0, len(tokens) - n + 1)) AS pos
        FROM (SELECT doc_id, {tokens(PLAIN)} AS tokens FROM docs) JOIN (SELECT DISTINCT n FROM short) ON len(tokens) >= n)),
word_for_word AS (
  SELECT doc_id, item_id, max(n_windows) AS n_windows, count(DISTINCT item_pos) AS n_matched
  FROM (SELECT *, count(*) OVER (PARTITION BY item_id, item_text) AS n_windows FROM short_windows) JOIN doc_windows USING (n, w) GROUP BY doc_id, item_id, item_text),
both_ways AS (
  SELECT * FROM by_evidence UNION ALL SELECT doc_id, item_id, n_windows, n_matched, n_matched / n_windows FROM word_for_word WHERE n_matched / n_windows >= {COVERAGE})
SELECT * FROM both_ways QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY share DESC, n_windows DESC, n_matched DESC) = 1
"""


SQL = _sql()
