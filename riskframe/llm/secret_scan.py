r"""Secret scan with multipart credential linking.

Three strong kinds are reported wherever they stand: ``assign`` (a password, secret, token or
key given a value), ``access`` (an access identifier) and ``hex`` (a long hexadecimal string).
Three weak kinds say little alone, since prose has user names, addresses and odd strings too:
``key`` (a string of mixed letters and digits), ``user`` (an identifier given a value) and
``endpoint`` (an address).  They are parts of one credential, and are reported only where the
parts that complete it are in the same scope:

* ``key``: an access identifier, or any identifier and an endpoint;
* ``user``: any secret (``assign``, ``hex`` or ``key``) and an endpoint;
* ``endpoint``: any identifier (``access`` or ``user``) and any secret.

A scope is the stretch of text between blank lines, and in it the ``SCOPE`` code points before
and after a candidate, start to start.  The scopes are joined as intervals: parts are dealt by
document, stretch and cell of ``SCOPE`` code points, each cell keeps its first and last part of a
role, and a candidate meets its own cell and the two beside it.  Parts of one cell are always
within reach and the first or last one of a neighbouring cell is the nearest, so the summary
loses nothing, and a document with very many parts makes one row a cell, not pairs.

Where a match begins is not told by Spark's functions: a text's pieces between matches and
the matches themselves are spread to rows, and running sums of their lengths give the code
points.  Texts themselves are never shuffled.  Only DataFrame functions run.

Defined results: null and empty texts have no spans, of which the digest is that of the empty
text; very long texts are read whole; repeated rows are answered each; a weak candidate that
overlaps a strong span or lies in an endpoint is that one's and not reported; an empty table gives no row;
extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskframe.llm._common import cut, file_backed, hold, located, pick, table

#: Code points between the starts of parts of one credential.
SCOPE = 400
#: Fewest characters of an assigned value, of an access identifier, of a hexadecimal string, of a weak key.
ASSIGNED, ACCESS, HEX, KEY = 8, 16, 32, 20

VALUE = r"""["']?\x20*[:=]\x20*["']?"""
# Names that announce a secret, an identifier or an address, and schemes of addresses.
SECRETS = "password|passwd|secret|token|api_?key"
USERS = "access_?key_?id|client_?id|account_?id|user_?name|user|login"
HOSTS = "endpoint|hostname|host|server|base_?url"
SCHEMES = "https?|ftp|wss?|jdbc:[a-z]+|postgres|postgresql|mysql|mongodb|redis|amqps?|s3"
#: Pattern of each kind, in the order of a report.  The least lengths that a pattern can say itself are in it: a
#: run of the class that is long enough is found from its first character as with ``+``.  An assigned value that
#: is too short takes up its text all the same, so its length is looked at afterwards.
PATTERNS = {
    "assign": rf"(?i:({SECRETS})){VALUE}([A-Za-z0-9+/_.=-]+)",
    "access": rf"AKIA[A-Z0-9]{{{ACCESS - 4},}}",
    "hex": rf"[0-9a-f]{{{HEX},}}",
    "key": rf"[A-Za-z0-9+/_-]{{{KEY},}}={{0,2}}",
    "user": rf"(?i:{USERS}){VALUE}[A-Za-z0-9+/_.@=-]{{3,}}",
    "endpoint": rf"""(?i:{SCHEMES})://[^\x20\x09-\x0D"'<>]+|(?i:{HOSTS}){VALUE}[A-Za-z0-9][A-Za-z0-9.:/_-]{{3,}}""",
    "blank": r"\n[\x20\x09\x0D]*\n",
}
KINDS = list(PATTERNS)
STRONG, WEAK, BLANK = KINDS[:3], KINDS[3:6], KINDS[6]
#: Which part of a credential a kind is.
ROLES = {"assign": "secret", "hex": "secret", "key": "secret", "access": "identifier", "user": "identifier", "endpoint": "endpoint"}
#: What a weak key's string holds at least one of.
MIXED = ("[a-z]", "[A-Z]", "[0-9]")
PLACE = ["_path", "_row"]


def _number(kind: str) -> Column:
    """A kind's place in the report's order."""
    return F.element_at(F.create_map(*[x for i, k in enumerate(KINDS) for x in (F.lit(k), F.lit(i))]), F.col(kind))


def _matches(rows: DataFrame) -> DataFrame:
    """(PLACE, kind, start, end, match): all matches of the patterns in ``rows`` (PLACE, text), of the weak
    kinds and blank lines only in texts with an identifier and a secret, of either strength."""
    every = lambda kind: F.regexp_extract_all("text", F.lit(PATTERNS[kind]), F.lit(0))
    found = hold(rows.withColumn("m", F.lit(None)), "m", F.struct(*[every(k).alias(k) for k in KINDS[:5]]))
    some = lambda *kinds: sum((F.size(f"m.{k}") for k in kinds), F.lit(0)) > 0
    whole = some("access", "user") & some("assign", "hex", "key")
    gap = lambda kind: F.transform(F.split("text", PATTERNS[kind], -1), F.length)
    row = lambda kind, m: F.struct(F.lit(kind).alias("kind"), m.alias("matches"), gap(kind).alias("gaps"))
    nothing = F.lit(None)
    sets = [F.when(some(k), row(k, F.col(f"m.{k}"))).otherwise(nothing) for k in STRONG]
    sets += [F.when(whole & some(k), row(k, F.col(f"m.{k}"))).otherwise(nothing) for k in ("key", "user")]
    sets += [F.when(whole, row(k, every(k))).otherwise(nothing) for k in ("endpoint", BLANK)]
    found = found.select(*PLACE, F.explode(F.array(*sets)).alias("s")).filter("s is not null")
    found = found.select(*PLACE, "s.kind", "s.gaps", F.posexplode("s.matches").alias("k", "match"))
    found = found.select(*PLACE, "kind", "k", "match", F.get("gaps", F.col("k")).alias("gap"), F.length("match").alias("size"))
    upto = Window.partitionBy(*PLACE, "kind").orderBy("k").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = found.withColumn("end", F.sum((F.col("gap") + F.col("size")).cast("long")).over(upto))
    return found.select(*PLACE, "kind", (F.col("end") - F.col("size")).alias("start"), "end", "match")


def _kept(found: DataFrame) -> DataFrame:
    """Without strong matches that are too short and weak keys that are not mixed."""
    value = F.length(F.regexp_extract("match", PATTERNS["assign"], 2))
    mixed = F.lit(True)
    for some in MIXED:
        mixed = mixed & F.col("match").rlike(some)
    good = F.when(F.col("kind") == "assign", value >= ASSIGNED).when(F.col("kind") == "key", mixed).otherwise(True)
    return found.filter(good).drop("match")


def _parts(spans: DataFrame) -> DataFrame:
    """(PLACE, kind, start, end, stretch): what may be part of a credential.  A weak span that overlaps a
    strong one is left out, and a key inside an endpoint."""
    ahead = Window.partitionBy(*PLACE).orderBy("start", "end", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    back = Window.partitionBy(*PLACE).orderBy(F.desc("start"), F.desc("end"), F.desc("kind")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    kind, strong = F.col("kind"), F.col("kind").isin(STRONG)
    last = lambda of: F.coalesce(F.max(F.when(of, F.col("end"))).over(ahead), F.lit(0))
    first = lambda of: F.min(F.when(of, F.col("start"))).over(back)
    over = lambda at: (F.col(f"{at}_last") > F.col("start")) | F.coalesce(F.col(f"{at}_first") < F.col("end"), F.lit(False))
    marked = spans.withColumn("stretch", F.count_if(kind == BLANK).over(ahead))
    marked = marked.withColumns({"strong_last": last(strong), "endpoint_last": last(kind == "endpoint")})
    marked = marked.withColumns({"strong_first": first(strong), "endpoint_first": first(kind == "endpoint")})
    taken = (kind.isin(WEAK) & over("strong")) | ((kind == "key") & over("endpoint"))
    return marked.filter((kind != BLANK) & ~taken).select(*PLACE, "kind", "start", "end", "stretch")


def _linked(parts: DataFrame, scope: int) -> DataFrame:
    """(PLACE, kind, start, end): the weak parts whose complements are in scope."""
    cell = F.floor(F.col("start") / scope)
    parts = parts.withColumn("cell", cell)
    role = lambda of: F.col("kind").isin([k for k, r in ROLES.items() if r == of])
    marks = {"access": F.col("kind") == "access", **{r: role(r) for r in ("identifier", "secret", "endpoint")}}
    near = [f(F.when(of, F.col("start"))).alias(f"{side}_{name}") for name, of in marks.items() for side, f in (("first", F.min), ("last", F.max))]
    cells = parts.groupBy(*PLACE, "stretch", "cell").agg(*near)
    asks = parts.filter(F.col("kind").isin(WEAK)).select(*PLACE, "kind", "start", "end", "stretch", F.explode(
        F.array(*[F.struct((F.col("cell") + d).alias("cell"), F.lit(d).alias("side")) for d in (-1, 0, 1)])).alias("to"))
    asks = asks.select(*PLACE, "kind", "start", "end", "stretch", "to.cell", "to.side")
    met = asks.join(cells, [*PLACE, "stretch", "cell"])
    start = F.col("start")

    def reach(name: str) -> Column:
        before, after = F.col(f"last_{name}"), F.col(f"first_{name}")
        within = F.when(F.col("side") < 0, start - before <= scope).when(F.col("side") > 0, after - start <= scope).otherwise(before.isNotNull())
        return F.bool_or(F.coalesce(within, F.lit(False))).alias(f"has_{name}")

    met = met.groupBy(*PLACE, "kind", "start", "end").agg(*[reach(name) for name in marks])
    has = lambda name: F.col(f"has_{name}")
    whole = (F.when(F.col("kind") == "key", has("access") | (has("identifier") & has("endpoint")))
             .when(F.col("kind") == "user", has("secret") & has("endpoint")).otherwise(has("identifier") & has("secret")))
    return met.filter(whole).select(*PLACE, "kind", "start", "end")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE) -> DataFrame:
    """Per row: id, ``n_assign``, ``n_access``, ``n_hex``, ``base_sha256`` (digest of the strong spans), ``spans``
    (all spans, ``kind:start:end`` by start, then kind) and ``n_linked``, how many of them are linked parts."""
    rows = located(file_backed(pick(docs, id_col, text_col)))
    texts = rows.select(*PLACE, F.col(text_col).alias("text")).filter("text is not null")
    spans = cut(_kept(_matches(texts)))
    base = spans.filter(F.col("kind").isin(STRONG))
    linked = _linked(_parts(spans), scope)
    all_spans = base.unionByName(linked)
    said = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    listed = all_spans.groupBy(*PLACE).agg(
        F.array_sort(F.collect_list(F.struct("start", _number("kind").alias("number"), "kind", "end"))).alias("all"),
        *[F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in STRONG])
    strong = F.filter("all", lambda s: s["number"] < len(STRONG))
    listed = listed.select(*PLACE, *[f"n_{k}" for k in STRONG], F.array_join(F.transform(strong, said), ",").alias("base"),
                           F.array_join(F.transform("all", said), ",").alias("spans"), (F.size("all") - F.size(strong)).cast("long").alias("n_linked"))
    out = rows.select(id_col, *PLACE).join(listed, PLACE, "left")
    count = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return out.select(id_col, *[count(f"n_{k}") for k in STRONG], F.sha2(F.coalesce("base", F.lit("")).cast("binary"), 256).alias("base_sha256"),
                      F.coalesce("spans", F.lit("")).alias("spans"), count("n_linked"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


def _sql() -> str:
    def spans(kind: str) -> str:
        p = PATTERNS[kind].replace("'", "''")
        value = f", length(regexp_extract(match, '{p}', 2)) AS value" if kind == "assign" else ", NULL AS value"
        return f"""SELECT row, '{kind}' AS kind, e - length(match) AS start, e AS "end", match{value}
            FROM (SELECT row, match, sum(length(match) + length(gap)) OVER (PARTITION BY row ORDER BY k) AS e
                  FROM (SELECT row, unnest(m) AS match, unnest(string_split_regex(text, '{p}')[1:len(m)]) AS gap, unnest(range(len(m))) AS k
                        FROM (SELECT row, text, regexp_extract_all(text, '{p}') AS m FROM texts) WHERE len(m) > 0))"""

    mixed = " AND ".join(f"regexp_matches(match, '{m}')" for m in MIXED)
    near = "p.row = c.row AND p.stretch = c.stretch AND abs(p.start - c.start) <= " + str(SCOPE)
    has = lambda *kinds: f"EXISTS (SELECT 1 FROM parts p WHERE {near} AND p.kind IN ({', '.join(repr(k) for k in kinds)}))"
    of = lambda role: has(*[k for k, r in ROLES.items() if r == role])
    order = "CASE kind " + " ".join(f"WHEN '{k}' THEN {i}" for i, k in enumerate(KINDS)) + " END"
    strong, weak = (", ".join(repr(k) for k in some) for some in (STRONG, WEAK))
    listed = lambda only: f"coalesce(string_agg(kind || ':' || start || ':' || \"end\", ',' ORDER BY start, {order}) {only}, '')"
    return f"""
WITH texts AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents),
matched AS MATERIALIZED ({' UNION ALL '.join(spans(k) for k in KINDS)}),
kept AS (SELECT row, kind, start, "end" FROM matched WHERE CASE kind WHEN 'assign' THEN value >= {ASSIGNED} WHEN 'key' THEN {mixed} ELSE true END),
free AS (
  SELECT * FROM kept k WHERE kind IN ({strong}) OR kind IN ({weak}) AND NOT EXISTS (
    SELECT 1 FROM kept o WHERE o.row = k.row AND o.start < k."end" AND o."end" > k.start
      AND (o.kind IN ({strong}) OR k.kind = 'key' AND o.kind = 'endpoint'))),
parts AS MATERIALIZED (SELECT *, (SELECT count(*) FROM kept b WHERE b.row = f.row AND b.kind = '{BLANK}' AND b.start <= f.start) AS stretch FROM free f),
spans AS (
  SELECT row, kind, start, "end" FROM parts WHERE kind IN ({strong})
  UNION ALL SELECT row, kind, start, "end" FROM parts c WHERE kind = 'key' AND ({has('access')} OR ({of('identifier')} AND {of('endpoint')}))
  UNION ALL SELECT row, kind, start, "end" FROM parts c WHERE kind = 'user' AND {of('secret')} AND {of('endpoint')}
  UNION ALL SELECT row, kind, start, "end" FROM parts c WHERE kind = 'endpoint' AND {of('identifier')} AND {of('secret')}),
said AS (
  SELECT row, {', '.join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in STRONG)}, count(*) FILTER (kind IN ({weak})) AS n_linked,
         {listed(f"FILTER (kind IN ({strong}))")} AS base, {listed('')} AS spans
  FROM spans GROUP BY row)
SELECT doc_id, {', '.join(f'coalesce(n_{k}, 0) AS n_{k}' for k in STRONG)}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans,
       coalesce(n_linked, 0) AS n_linked
FROM texts LEFT JOIN said USING (row)
"""


SQL = _sql()
