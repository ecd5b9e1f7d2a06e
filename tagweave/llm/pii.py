"""Personal data by weak supervision, in DataFrame functions alone.

1. Base patterns and looser ones propose spans. A pattern's matches and the gaps
   between them give positions as running sums over a document's matches, so texts
   are scanned in place and only matches are shuffled.
2. Labelers vote on each span: format (digits, checksum, octets), pattern, gazetteer
   (domains, country codes, issuers), context words before it, and its borders. A
   vote is 1, 0 (abstain) or -1.
3. Votes are counted by pattern of votes, of which there are at most a few
   thousand. Expectation-maximisation over these counts estimates how reliable each
   labeler is and how likely a span with given votes is personal data.
4. A logistic classifier on kind, votes and length is trained on those
   probabilities. It becomes a column expression over all spans. Base spans that
   pass their format check stay; a looser span is added where the classifier is
   sure and no base span of its kind overlaps it.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from tagweave.llm.common import small_batches, staged

KINDS = ("email", "ip", "card", "phone")
_LOCAL = "[A-Za-z0-9._%+-]"
#: Patterns by name: kind, whether base, a string without which nothing matches, the
#: pattern. Repetitions that never need to give back are possessive, and runs are
#: entered at their start only, so the time is linear in the text.
PATTERNS = {
    "email": ("email", True, "@",
              rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
    "ip": ("ip", True, ".", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"),
    "card": ("card", True, "", r"[0-9](?:[ -]?[0-9])++"),
    "phone": ("phone", True, "+", r"\+[0-9][ ().0-9-]+[0-9]"),
    "email_words": ("email", False, "at",
                    rf"(?<!{_LOCAL}){_LOCAL}++ ?[\[(]at[\])] ?[A-Za-z0-9-]++"
                    r"(?: ?(?:\.|[\[(]dot[\])]) ?[A-Za-z0-9-]++)++"),
    "card_alone": ("card", False, "",
                   r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3})(?![0-9])"),
    "phone_shape": ("phone", False, "+",
                    r"\+[0-9]{1,3}[ .-]?\(?[0-9]{2,4}\)?[ .-][0-9]{3}[ .-][0-9]{3,4}(?![0-9])"),
}
DOMAINS = ("com", "org", "net", "edu", "gov", "de", "fr", "es", "uk", "io", "info", "eu")
COUNTRY_CODES = ("1", "7", "31", "32", "33", "34", "39", "41", "43", "44", "45", "46", "47",
                 "48", "49", "52", "55", "61", "81", "82", "86", "91")
#: Prefixes of card issuers.
ISSUERS = "^(?:4|5[1-5]|2[2-7]|3[47]|6011|65|35)"
PERSONAL = (r"(?i)(?:e-?mail|mail|contact|phone|tel|call|mobile|fax|card|visa|credit|ip|host|"
            r"address|server)[^A-Za-z0-9]{0,4}$")
TECHNICAL = r"(?i)(?:token|key|hash|sha|md5|version|isbn|serial|id|build)[^A-Za-z0-9]{0,4}$"
LABELERS = ("by_format", "by_pattern", "by_gazetteer", "by_context", "by_border")
#: Probability from which a looser span is added.
SURE = 0.9
LOWEST = -(1 << 63)


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    turned = F.reverse(digits)
    values = F.transform(
        F.sequence(F.lit(1), F.length(digits)),
        lambda i: F.when(i % 2 == 1, F.substring(turned, i, F.lit(1)).cast("int"))
        .otherwise(F.substring(turned, i, F.lit(1)).cast("int") * 2
                   - 9 * (F.substring(turned, i, F.lit(1)).cast("int") > 4).cast("int")))
    return F.aggregate(values, F.lit(0), lambda total, x: total + x) % 10 == 0


def _well_formed(kind: Column, match: Column) -> Column:
    digits = _digits(match)
    octet = r"0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])"
    return (F.when(kind == "email", F.lit(True))
            .when(kind == "ip", match.rlike(rf"^{octet}\.{octet}\.{octet}\.{octet}$"))
            .when(kind == "phone", F.length(digits).between(9, 15))
            .otherwise(F.when(F.length(digits).between(13, 19), luhn(digits))
                       .otherwise(F.lit(False))))


def _proposed(docs: DataFrame) -> DataFrame:
    """One row for each match of each pattern, with what surrounds it."""
    empty = F.array().cast("array<string>")
    text, columns = F.col("text"), []
    has_digit = text.rlike("[0-9]")
    for name, (_, _, needed, pattern) in PATTERNS.items():
        may = text.contains(needed) if needed else has_digit
        columns += [
            F.when(may, F.regexp_extract_all("text", F.lit(pattern), F.lit(0)))
            .otherwise(empty).alias(f"m_{name}"),
            F.when(may, F.split("text", pattern, -1)).otherwise(empty).alias(f"g_{name}")]

    def spans(name):
        kind, base, _, _ = PATTERNS[name]
        gap = F.col(f"g_{name}")
        return F.transform(f"m_{name}", lambda x, i: F.struct(
            F.lit(kind).alias("kind"), F.lit(name).alias("pattern"), F.lit(base).alias("base"),
            i.alias("place"), F.length(F.get(gap, i)).alias("gap"), x.alias("match"),
            F.right(F.get(gap, i), F.lit(24)).alias("before"),
            F.substring(F.get(gap, i + 1), 1, 1).alias("after")))

    found = docs.select("id", "h", *columns)
    return found.select("id", "h", F.explode(F.concat(*map(spans, PATTERNS))).alias("s")).select(
        "id", "h", "s.*")


def _voted(proposed: DataFrame) -> DataFrame:
    """Spans with positions and votes; equal rows of documents count once."""
    parts = int(proposed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    once = proposed.repartition(parts, "id", "h").dropDuplicates(["id", "h", "pattern", "place"])
    so_far = Window.partitionBy("id", "h", "pattern").orderBy("place").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    size = F.length("match")
    kind, match = F.col("kind"), F.col("match")
    vote = lambda yes, no=F.lit(False): (
        F.when(yes, 1).when(no, -1).otherwise(0).cast("int"))
    known = (F.when(kind == "email", F.lower(F.regexp_extract(match, "([A-Za-z]+)$", 1))
                    .isin(*DOMAINS))
             .when(kind == "phone", F.regexp_extract(match, r"^\+([0-9]{1,3})", 1)
                   .isin(*COUNTRY_CODES))
             .when(kind == "card", _digits(match).rlike(ISSUERS))
             .otherwise(~match.rlike(r"^(?:0|10|127|255)\.")))
    border_bad = F.col("before").rlike(r"[A-Za-z0-9@=_\"'#/]$") | F.col("after").rlike(
        r"^[A-Za-z0-9@=_\"'#/]")
    return (once.withColumn("end", F.sum(F.col("gap") + size).over(so_far))
            .withColumn("start", F.col("end") - size)
            .withColumn("formed", _well_formed(kind, match))
            .select("id", "h", "kind", "base", "formed", "start", "end",
                    vote(F.col("formed"), ~F.col("formed")).alias("by_format"),
                    vote(F.col("base")).alias("by_pattern"),
                    vote(known).alias("by_gazetteer"),
                    vote(F.col("before").rlike(PERSONAL), F.col("before").rlike(TECHNICAL))
                    .alias("by_context"),
                    vote(~border_bad, border_bad).alias("by_border"),
                    F.least(F.floor(size / 8), F.lit(4)).cast("int").alias("length")))


def reliabilities(counts: list[tuple], rounds: int = 30) -> tuple[dict, list[float]]:
    """Expectation-maximisation over (kind, votes, length, count) rows.

    Returns how often each labeler casts each vote on spans that are personal data
    (key (labeler, 1, vote)) and on others ((labeler, 0, vote)), and the probability
    for each row. Begins with the share of positive votes.
    """
    chance = [(1 + sum(v > 0 for v in votes)) / (2 + sum(v != 0 for v in votes))
              for _, votes, _, _ in counts]
    rates: dict = {}
    for _ in range(rounds):
        total: dict = {}
        for (kind, votes, _, n), p in zip(counts, chance):
            for truth, w in ((1, p * n), (0, (1 - p) * n)):
                total[kind, truth] = total.get((kind, truth), 0) + w
                for k, v in enumerate(votes):
                    total[k, truth, v] = total.get((k, truth, v), 0) + w
                    total[k, truth] = total.get((k, truth), 0) + w
        rates = {(k, truth, v): (total.get((k, truth, v), 0) + 0.1)
                 / (total.get((k, truth), 0) + 0.3)
                 for k in range(len(LABELERS)) for truth in (0, 1) for v in (-1, 0, 1)}
        chance = []
        for kind, votes, _, _ in counts:
            odds = math.log((total.get((kind, 1), 0) + 1) / (total.get((kind, 0), 0) + 1))
            odds += sum(math.log(rates[k, 1, v] / rates[k, 0, v]) for k, v in enumerate(votes))
            chance.append(1 / (1 + math.exp(-max(-30.0, min(30.0, odds)))))
    return rates, chance


def _features(kind: str, votes, length: int) -> list[tuple]:
    return [("kind", kind), ("length", length), *zip(LABELERS, votes)]


def classifier(counts: list[tuple], chance: list[float], rounds: int = 200) -> dict:
    """Weights of a logistic model on the features, by gradient steps on soft labels."""
    whole = sum(n for *_, n in counts) or 1
    weights: dict = {}
    for step in range(rounds):
        slopes: dict = {}
        for (kind, votes, length, n), p in zip(counts, chance):
            names = _features(kind, votes, length)
            z = sum(weights.get(f, 0.0) for f in names)
            miss = (p - 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))) * n / whole
            for f in names:
                slopes[f] = slopes.get(f, 0.0) + miss
        for f, slope in slopes.items():
            weights[f] = weights.get(f, 0.0) + 4.0 * slope - 1e-4 * weights.get(f, 0.0)
    return weights


def _probability(weights: dict) -> Column:
    total = F.lit(0.0)
    for (name, value), weight in sorted(weights.items(), key=str):
        total = total + F.when(F.col(name) == value, float(weight)).otherwise(0.0)
    return 1 / (1 + F.exp(-total))


def find_personal_data(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text"
                       ) -> DataFrame:
    """Per row: doc_id, counts and list of base spans, list of all spans.

    ``n_email``, ``n_ip``, ``n_card`` and ``n_phone`` count base spans; ``base`` and
    ``spans`` list kind:start:end by kind, then start, joined by commas, in code
    points with the end exclusive. A null or empty text has none. Each row is
    searched whole; equal rows have equal results, a null id is kept. Other columns
    are ignored.
    """
    small_batches(docs.sparkSession)
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    given = docs.select(F.coalesce(F.col(id_column).cast("long"), F.lit(LOWEST)).alias("id"),
                        F.xxhash64(text).alias("h"), text.alias("text"))
    spans = staged(_voted(_proposed(given)), "spans")
    patterns = spans.groupBy("kind", *LABELERS, "length").agg(F.count("*").alias("n"))
    counts = sorted((r["kind"], tuple(r[x] for x in LABELERS), r["length"], r["n"])
                    for r in patterns.collect())  # at most 4 x 3^5 x 5 rows
    weights = classifier(counts, reliabilities(counts)[1])
    base = F.col("base") & F.col("formed")
    here = Window.partitionBy("id", "h", "kind")
    ahead = here.orderBy("start", F.desc("is_base"), "end").rowsBetween(
        Window.unboundedPreceding, -1)
    behind = here.orderBy(F.desc("start"), "is_base", F.desc("end")).rowsBetween(
        Window.unboundedPreceding, -1)
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    judged = (spans.repartition(parts, "id", "h").withColumn("is_base", base)
              .withColumn("chance", _probability(weights))
              .withColumn("last", F.max(F.when(F.col("is_base"), F.col("end"))).over(ahead))
              .withColumn("next", F.min(F.when(F.col("is_base"), F.col("start"))).over(behind)))
    clear = ((F.coalesce("last", F.lit(0)) <= F.col("start"))
             & (F.coalesce("next", F.col("end")) >= F.col("end")))
    added = ~F.col("base") & F.col("formed") & (F.col("chance") >= SURE) & clear
    order = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    item = F.struct(order.alias("order"), "start",
                    F.concat_ws(":", "kind", "start", "end").alias("shown"))
    listed = lambda c: F.array_join(F.transform(
        F.array_sort(F.collect_list(F.when(c, item))), lambda x: x["shown"]), ",")
    per_doc = judged.groupBy("id", "h").agg(
        *[F.sum(F.when(F.col("is_base") & (F.col("kind") == k), 1).otherwise(0)).alias(f"n_{k}")
          for k in KINDS],
        listed(F.col("is_base")).alias("base"), listed(F.col("is_base") | added).alias("spans"))
    out = given.select("id", "h").join(per_doc, ["id", "h"], "left")
    return out.select(
        F.when(F.col("id") != LOWEST, F.col("id")).alias("doc_id"),
        *[F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in KINDS],
        F.coalesce("base", F.lit("")).alias("base"), F.coalesce("spans", F.lit("")).alias("spans"))
