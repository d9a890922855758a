"""Secret scan: fixed patterns plus a randomness test battery, in DataFrame functions only.

Base kinds are the leftmost non-overlapping matches of three patterns. The battery looks at
every other run of key characters that holds a letter, leaves out its separators, infers its
encoding (hex, letters, base32, base36, base62) and asks three questions of it against the null
of an ordinary string (words, names, slugs, numbers):

* chi-squared alphabet uniformity: P(statistic this small | noncentral chi-squared with the
  collision rate of text); of letters and base32, pooled as common, middling and rare letters;
* runs of character classes (digits, cases; of letters, vowels): P(this close to the changes of
  a random string | changes as in text);
* serial dependence of neighbours: P(share of frequent letter pairs this close to a random
  string's | share as in text); of hex, P(lag-one correlation this near zero | as in text). A
  string whose lag-one correlation is over ``SERIAL_LIMIT`` (alphabets, counters) is not random.

Each test's evidence grows with the length. Fisher's method combines the three, and the
Benjamini-Hochberg step-up over all documents, by stratum of length and of letters alone or
not, admits spans at false discovery rate ``FDR``. The step-up works on counts per stratum and
quarter-log2 bin of p (conservatively: on each bin's upper edge), so the driver sees one number
per stratum.

Both passes are maps over the documents; the text is never shuffled.

Defined results: a null text counts as empty and has no spans; repeated rows give repeated
result rows; a null doc_id is kept; overlapping spans of different kinds are all reported;
battery spans inside a base span are not; an empty table gives an empty result; columns beside
the id and the text are ignored, whatever their names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.llm.common import table

#: Kinds in the order in which spans that start together are listed.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: Shorter matches of AKIA[A-Z0-9]+ and [0-9a-f]+ fail, and a failing match hides no longer one.
ACCESS, HEX = "AKIA[A-Z0-9]{16,}", "[0-9a-f]{24,}"
ASSIGN_VALUE = 6
#: Runs of at least 16 key characters; the battery judges those with a letter.
CANDIDATE, BETWEEN = "[A-Za-z0-9+/_=-]{16,}", "[+/_=-]+"

#: name, pattern of the characters without separators, alphabet in code order, share of
#: neighbours of different classes in an ordinary and in a random string
ENCODINGS = (
    ("hex", "^(?=.*[0-9])([0-9a-f]+|[0-9A-F]+)$", "0123456789abcdef", 0.1, 0.469),
    ("letters", "^[A-Za-z]+$", "abcdefghijklmnopqrstuvwxyz", 0.58, 0.311),
    ("base32", "^[A-Z2-7]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", 0.1, 0.305),
    ("base36", "^([0-9a-z]+|[0-9A-Z]+)$", "0123456789abcdefghijklmnopqrstuvwxyz", 0.1, 0.401),
    ("base62", "", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", 0.25, 0.622),
)
HEX_CODE, LETTERS_CODE, BASE32_CODE = 0, 1, 2
#: Ordinary strings: collision probability of two characters (at least twice the alphabet's)
#: and correlation of neighbours.
TEXT_COLLISION, TEXT_CORRELATION = 0.06, 0.3
#: Letters by frequency, and their shares in text.
POOLS = (("etaoinsr", 0.63), ("hldcumfpgw", 0.30), ("ybvkxjqz", 0.07))
#: The most frequent letter pairs of English text, and the pairs' least share of
#: neighbouring letters in text (of any language with Latin letters).
PAIRS = ("th he in er an re on at en nd ti es or te of ed is it al ar st to nt ng se ha as ou io le ve co me de hi ri ro ic ne ea"
         " ra ce li ch ll be ma si om ur").split()
TEXT_PAIRS, RANDOM_PAIRS = 0.45, len(PAIRS) / 26 ** 2
#: Lag-one correlation above which a string follows a rule.
SERIAL_LIMIT = 0.6
FDR = 0.01
#: Lower length bounds of the strata; strings of letters alone have strata of their own.
STRATA = (16, 24, 40)
#: Quarter-log2 bins of p.
BINS = 400


def found(text: Column, pattern: str, keep) -> Column:
    """array<struct<start, end, hit>> of those leftmost non-overlapping matches whose text
    passes ``keep``, in code points: the pieces between the matches give the positions."""
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.split(text, pattern, -1)
    steps = F.zip_with(hits, F.slice(pieces, F.lit(1), F.size(hits)), lambda h, p: F.struct(
        F.length(p).cast("long").alias("gap"), F.length(h).cast("long").alias("len"), h.alias("hit"), keep(h).alias("keep")))
    kind = "array<struct<start:bigint,end:bigint,hit:string>>"
    nothing = F.array().cast(kind)
    spans = F.aggregate(steps, F.struct(F.lit(0).cast("long").alias("at"), nothing.alias("out")), _next_span, lambda a: a["out"])
    return F.when(F.size(hits) > 0, spans).otherwise(nothing)


def _next_span(a: Column, s: Column) -> Column:
    start = a["at"] + s["gap"]
    one = F.array(F.struct(start.alias("start"), (start + s["len"]).alias("end"), s["hit"].alias("hit")))
    return F.struct((start + s["len"]).alias("at"), F.when(s["keep"], F.concat(a["out"], one)).otherwise(a["out"]).alias("out"))


def base_spans(text: Column) -> Column:
    """array<struct<start, kind, end>> of the three base kinds, in listing order."""
    every = lambda h: F.lit(True)
    assign = found(text, ASSIGN, lambda h: F.length(F.regexp_extract(h, ASSIGN, 2)) >= ASSIGN_VALUE)
    return F.array_sort(F.concat(_as_kind(assign, 0), _as_kind(found(text, ACCESS, every), 1), _as_kind(found(text, HEX, every), 2)))


def _as_kind(spans: Column, kind: int) -> Column:
    return F.transform(spans, lambda m: F.struct(m["start"].alias("start"), F.lit(kind).alias("kind"), m["end"].alias("end")))


def _below(z: Column) -> Column:
    """Upper bound of the normal probability below z (tight enough in the tail)."""
    tail = 0.5 * F.exp(-z * z / 2)
    return F.when(z <= 0, tail).otherwise(1 - tail)


def encoded(hit: Column) -> tuple[Column, Column]:
    """The string without separators, in one case where its inferred encoding has one, and the
    encoding's index."""
    bare = F.regexp_replace(hit, BETWEEN, "")
    code = F.lit(len(ENCODINGS) - 1)
    for k in range(len(ENCODINGS) - 2, -1, -1):
        code = F.when(bare.rlike(ENCODINGS[k][1]), k).otherwise(code)
    one_case = [k for k, e in enumerate(ENCODINGS) if e[2] == e[2].lower()]
    return F.when(code.isin(one_case), F.lower(bare)).otherwise(bare), code


def _of_code(code: Column, values) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), code + 1)


def _as_random(seen: Column, at_random: Column, usual: Column, spread: Column) -> Column:
    """P(as near to a random string's count as seen | a count as usual, with this spread)."""
    return _below((F.abs(seen - at_random) - F.abs(usual - at_random)) / spread)


def _pooled(s: Column, n: Column) -> Column:
    """Uniformity of n letters pooled by frequency: P(chi-squared this small | text's shares)."""
    chi, shift = F.lit(0.0), 0.0
    for letters, share in POOLS:
        even = len(letters) / 26
        count = F.length(F.regexp_replace(s, f"[^{letters}]+", ""))
        chi += F.pow(count - n * even, F.lit(2.0)) / (n * even)
        shift += (share - even) ** 2 / even
    return _below(F.sqrt(chi) - F.sqrt(n * shift))


def battery_p(s: Column, code: Column) -> Column:
    """Combined p-value of a string in an encoding under the null of an ordinary string."""
    letters = _of_code(code, [e[2] for e in ENCODINGS])
    size = F.length(letters).cast("double")
    n = F.greatest(F.length(s), F.lit(4)).cast("double")
    squares = F.aggregate(F.split(letters, ""), F.lit(0.0),
                          lambda a, c: a + F.pow(F.length(s) - F.length(F.replace(s, c, F.lit(""))), F.lit(2.0)))
    chi = size / n * squares - n
    shift = n * (size * F.greatest(F.lit(TEXT_COLLISION), 2 / size) - 1)
    low = F.lower(s)
    of_letters = F.greatest(F.length(F.regexp_replace(s, "[0-9]+", "")), F.lit(1))
    p_chi = F.when(code.isin(LETTERS_CODE, BASE32_CODE), _pooled(low, of_letters)).otherwise(_below((chi - (size - 1 + shift)) / F.sqrt(2 * (size - 1) + 4 * shift)))

    text_rate, random_rate = _of_code(code, [e[3] for e in ENCODINGS]), _of_code(code, [e[4] for e in ENCODINGS])
    runs = F.when(code == LETTERS_CODE, F.regexp_replace(s, "[aeiou]+|[^aeiou]+", "x")).otherwise(F.regexp_replace(s, "[0-9]+|[a-z]+|[A-Z]+", "x"))
    p_runs = _as_random(F.length(runs) - 1, (n - 1) * random_rate, (n - 1) * text_rate, F.sqrt((n - 1) * text_rate * (1 - text_rate)))

    # correlation of neighbours in one pass: sums of x, x*x and x*next
    r = F.least(F.abs(F.aggregate(
        F.split(s, ""), F.struct(F.lit(0.0).alias("x"), F.lit(0.0).alias("xx"), F.lit(0.0).alias("xy"), F.lit(0.0).alias("last"), F.lit(-1.0).alias("first")),
        lambda a, c: _next_sums(a, F.call_function("locate", c, letters).cast("double")), lambda a: _correlation(a, n))), F.lit(0.999))
    near = F.length(F.regexp_replace(low, "(?=[a-z][a-z])", "#")) - F.length(s)
    frequent = F.length(F.regexp_replace(low, f"(?={'|'.join(PAIRS)})", "#")) - F.length(s)
    p_pairs = _as_random(frequent, near * RANDOM_PAIRS, near * TEXT_PAIRS, F.sqrt(F.greatest(near, F.lit(1)) * TEXT_PAIRS * (1 - TEXT_PAIRS)))
    p_serial = F.when(code == HEX_CODE, _below((F.atanh(r) - F.atanh(F.lit(TEXT_CORRELATION))) * F.sqrt(n - 3))).otherwise(p_pairs)

    half = -(F.log(p_chi + 1e-300) + F.log(p_runs + 1e-300) + F.log(p_serial + 1e-300))
    p = F.exp(-half) * (1 + half + half * half / 2)  # chi-squared tail, six degrees of freedom
    return F.when(r > SERIAL_LIMIT, 1.0).otherwise(p)


def _next_sums(a: Column, x: Column) -> Column:
    return F.struct((a["x"] + x).alias("x"), (a["xx"] + x * x).alias("xx"), (a["xy"] + a["last"] * x).alias("xy"), x.alias("last"),
                    F.when(a["first"] < 0, x).otherwise(a["first"]).alias("first"))


def _correlation(a: Column, n: Column) -> Column:
    mean = a["x"] / n
    spread = a["xx"] - n * mean * mean
    cross = a["xy"] - mean * (2 * a["x"] - a["first"] - a["last"]) + (n - 1) * mean * mean
    return F.when(spread > 1e-9, cross / spread).otherwise(F.lit(0.999))


def candidates(text: Column) -> Column:
    """array<struct<start, end, stratum, p>> of the strings that the battery judges."""
    judged = found(text, CANDIDATE, lambda h: h.rlike("[A-Za-z]"))
    spelled = F.transform(judged, lambda m: F.struct(
        m["start"].alias("start"), m["end"].alias("end"), encoded(m["hit"])[0].alias("plain"), encoded(m["hit"])[1].alias("code")))
    return F.transform(spelled, lambda m: F.struct(
        m["start"].alias("start"), m["end"].alias("end"), _stratum(m["end"] - m["start"], m["code"]).alias("stratum"),
        battery_p(m["plain"], m["code"]).alias("p")))


def _stratum(n: Column, code: Column) -> Column:
    by_length = reduce(lambda a, k: F.when(n >= STRATA[k], F.lit(k)).otherwise(a), range(1, len(STRATA)), F.lit(0))
    return by_length + F.when(code == LETTERS_CODE, len(STRATA)).otherwise(0)


def thresholds(docs: DataFrame, fdr: float = FDR) -> list[float]:
    """Largest admitted p by stratum, from all documents (column text)."""
    judged = docs.select(F.explode(candidates(F.coalesce("text", F.lit("")))).alias("c")).select("c.stratum", "c.p")
    bins = (judged.withColumn("bin", F.least(F.lit(BINS), F.floor(-4 * F.log2(F.col("p") + 1e-300))).cast("int"))
            .groupBy("stratum", "bin").agg(F.count(F.lit(1)).alias("n")))
    total = F.expr("sum(n) over (partition by stratum)")
    upto = F.expr("sum(n) over (partition by stratum order by bin desc)")
    edge = F.pow(F.lit(2.0), -F.col("bin") / 4)
    rows = (bins.select("stratum", "bin", total.alias("m"), upto.alias("k"))
            .where(edge * F.col("m") <= F.lit(fdr) * F.col("k"))
            .groupBy("stratum").agg(F.max(edge).alias("edge")).collect())
    by = {r["stratum"]: r["edge"] for r in rows}
    return [by.get(k, 0.0) for k in range(2 * len(STRATA))]


def scan(docs: DataFrame, fdr: float = FDR, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, base, spans) of every row; base and spans: array<struct<start, kind, end>>
    with kind an index of KINDS, in listing order. ``text`` is as it came."""
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return with_spans(src, F.col("text"), thresholds(src, fdr))


def with_spans(rows: DataFrame, text: Column, edges: list[float]) -> DataFrame:
    """``rows`` with the columns base and spans of the text, given the battery's thresholds."""
    text = F.coalesce(text, F.lit(""))
    kind = "array<struct<start:bigint,kind:int,end:bigint>>"
    rows = rows.withColumns({"base": base_spans(text).cast(kind), "judged": candidates(text)})
    limit = F.array(*[F.lit(float(x)) for x in edges])
    random = F.filter("judged", lambda c: (c["p"] <= F.element_at(limit, c["stratum"] + 1)) & ~F.exists(
        F.col("base"), lambda b: (b["start"] <= c["start"]) & (b["end"] >= c["end"])))
    return rows.withColumn("spans", F.array_sort(F.concat("base", _as_kind(random, 3).cast(kind)))).drop("judged")


def redact(docs: DataFrame, fdr: float = FDR, text_col: str = "text", mark: str = "[secret]") -> DataFrame:
    """``docs`` (all columns, whatever their names) with every found span of the text replaced."""
    edges = thresholds(docs.select(F.col(text_col).cast("string").alias("text")), fdr)
    held = docs.select(F.struct(*docs.columns).alias("row"), F.col(text_col).cast("string").alias("text"))
    clean = redacted(F.col("text"), F.col("spans"), mark)
    return with_spans(held, F.col("text"), edges).select(
        *[clean.alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns])


def listed(spans: Column) -> Column:
    """kind:start:end of all spans, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(text: Column, spans: Column, mark: str = "[secret]") -> Column:
    """The text with every span (overlapping ones together) replaced by ``mark``."""
    state = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))
    step = lambda a, s: F.struct(
        F.when(s["start"] >= a["at"], F.concat(a["out"], F.substring(text, a["at"] + 1, s["start"] - a["at"]), F.lit(mark)))
        .otherwise(a["out"]).alias("out"), F.greatest(a["at"], s["end"]).alias("at"))
    done = F.aggregate(spans, state, step, lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, done).otherwise(text)


def digest(rows: DataFrame) -> DataFrame:
    """Counts, hash and listing of scanned rows."""
    def of_kind(k):
        return F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{KINDS[k]}")

    return rows.select("doc_id", of_kind(0), of_kind(1), of_kind(2), F.sha2(listed(F.col("base")), 256).alias("base_sha256"),
                       listed(F.col("spans")).alias("spans"))


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(scan(table(spark, sf_dir, "documents")))
