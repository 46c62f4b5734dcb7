"""Learning from corrections: changes, counts, rules, parameters, regressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import textkit as tk

# Kinds of change, the threshold of all rules, the detector's default and step.
KINDS = ("boilerplate_removal", "formula_fix", "heading_change", "image_reorder", "text_fix")
THRESHOLD, BASE, STEP, TOLERANCE = 3, 0.45, 0.05, -0.5
FORMULA, HEADING, IMAGE = r"\$[^$]+\$", r"^#{1,6}\s", r"!\[[^\]]*\]\([^)]*\)"


def classify(before: Column, after: Column) -> Column:
    """The kind of a change; a line without a successor was removed."""
    either = lambda p: before.rlike(p) | after.rlike(p)
    return F.when(after.isNull(), KINDS[0]).when(either(FORMULA), KINDS[1]).when(either(HEADING), KINDS[2]).when(either(IMAGE), KINDS[3]).otherwise(KINDS[4])


def flatten(log: DataFrame) -> DataFrame:
    """One row a correction of each log entry, the journal ``unknown`` where it is not given."""
    return log.select("paper_key", F.coalesce("journal_profile", F.lit("unknown")).alias("journal"), F.inline("corrections"))


def counts(corrections: DataFrame, key: str = "paper_key") -> DataFrame:
    """Changes of each kind, zero where there are none."""
    return corrections.groupBy(key).pivot("type", list(KINDS)).count().na.fill(0)


def formula_rule(corrections: DataFrame, params: DataFrame) -> DataFrame:
    """Proposals to lower the threshold where formulas were added three times, and to raise it where they were removed."""
    had, has = F.col("before").rlike(FORMULA), F.coalesce(F.col("after").rlike(FORMULA), F.lit(False))
    n = corrections.filter(F.col("type") == KINDS[1]).groupBy("journal").agg(F.count_if(has & ~F.coalesce(had, F.lit(False))).alias("added"), F.count_if(F.coalesce(had, F.lit(False)) & ~has).alias("removed"))
    n = n.join(params.select("journal", "mfd_conf_override"), "journal", "left").withColumn("base", F.coalesce("mfd_conf_override", F.lit(BASE)))
    of = lambda count, action, sign: n.filter(F.col(count) >= THRESHOLD).select("journal", F.lit(action).alias("action"), F.round(F.col("base") + sign * STEP, 4).alias("value"), F.col(count).alias("n"))
    return of("added", "lower", -1).unionAll(of("removed", "raise", 1))


def boilerplate_rule(corrections: DataFrame, params: DataFrame) -> DataFrame:
    """Texts removed three times or more that are not stored yet."""
    t = corrections.filter("type = 'boilerplate_removal'").withColumn("text", tk.strip(F.col("before"))).filter("text <> ''")
    often = t.groupBy("journal", "text").agg(F.count("*").alias("n")).filter(F.col("n") >= THRESHOLD)
    stored = params.select(F.col("journal"), F.explode("extra_boilerplate_patterns").alias("text"))
    return often.join(stored, ["journal", "text"], "left_anti")


def heading_rule(corrections: DataFrame, params: DataFrame) -> DataFrame:
    """Heading changes made three times or more and stored otherwise or not at all."""
    h = corrections.filter("type = 'heading_change'").select("journal", tk.strip(F.col("before")).alias("before"), tk.strip(F.col("after")).alias("after")).filter("before <> '' and after <> '' and before <> after")
    often = h.groupBy("journal", "before", "after").agg(F.count("*").alias("n")).filter(F.col("n") >= THRESHOLD)
    stored = params.select("journal", F.explode("heading_remap").alias("before", "after"))
    return often.join(stored, ["journal", "before", "after"], "left_anti")


def character_rule(corrections: DataFrame) -> DataFrame:
    """Single-character changes in lines of equal length, made three times or more."""
    chars = lambda c: F.split(F.col(c), "")
    c = corrections.filter("type = 'text_fix'").filter(F.length("before") == F.length("after"))
    c = c.withColumn("d", F.filter(F.zip_with(chars("before"), chars("after"), lambda x, y: F.struct(x.alias("f"), y.alias("t"))), lambda p: p["f"] != p["t"])).filter("size(d) = 1")
    return c.groupBy("journal", F.col("d")[0]["f"].alias("replace"), F.col("d")[0]["t"].alias("with")).agg(F.count("*").alias("n")).filter(F.col("n") >= THRESHOLD)


def image_reorders(original: DataFrame, corrected: DataFrame) -> DataFrame:
    """Image references (``doc_id, idx, ref``) of both texts whose place among the references differs; of repeated ones the last place counts."""
    last = lambda d, name: d.groupBy("doc_id", "ref").agg(F.max("idx").alias(name))
    return last(original, "was").join(last(corrected, "now"), ["doc_id", "ref"]).filter("was <> now")


def baseline(scores: DataFrame) -> DataFrame:
    """The best total of each paper, keys that begin with an underscore aside."""
    return scores.filter(~F.col("paper_key").startswith("_")).groupBy("paper_key").agg(F.max("total").alias("best_total"))


def regressions(known: DataFrame, base: DataFrame, current: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """Known papers with their baseline, present best, difference and status."""
    d = known.join(base.select("paper_key", F.col("best_total").alias("baseline")), "paper_key", "left").join(current.select("paper_key", F.col("best_total").alias("current")), "paper_key", "left")
    d = d.withColumn("delta", F.round(F.col("current") - F.col("baseline"), 3))
    status = F.when(F.col("baseline").isNull(), "no_baseline").when(F.col("current").isNull(), "no_current_score").when(F.col("delta") < tolerance, "regressed").otherwise("ok")
    return d.withColumn("status", status)


def upsert(old: DataFrame, new: DataFrame, key) -> DataFrame:
    """Rows of ``new``, and those of ``old`` whose key is not among them."""
    key = [key] if isinstance(key, str) else key
    return old.join(new.select(*key), key, "left_anti").unionByName(new)


def apply_thresholds(params: DataFrame, proposals: DataFrame, date: Column) -> DataFrame:
    """Parameters with proposed thresholds taken in rule order (lower, then raise), each change in the history.

    ``params``: ``journal, mfd_conf_override, history``; new journals get a row.
    """
    made = F.struct(date.cast("string").alias("date"), F.col("action").alias("reason"), F.col("value").cast("string").alias("new"))
    p = proposals.groupBy("journal").agg(F.array_sort(F.collect_list(F.struct("action", F.col("value").alias("value"), made.alias("entry")))).alias("steps"))
    joined = params.join(p, "journal", "full_outer")
    entries = F.transform("steps", lambda x: F.struct(x["entry"]["date"].alias("date"), F.lit("mfd_conf_override").alias("param"), F.col("mfd_conf_override").cast("string").alias("old"), x["entry"]["new"].alias("new"), x["entry"]["reason"].alias("reason")))
    none = F.array().cast("array<struct<date:string,param:string,old:string,new:string,reason:string>>")
    return joined.select("journal", F.coalesce(F.element_at("steps", -1)["value"], F.col("mfd_conf_override")).alias("mfd_conf_override"), F.concat(F.coalesce("history", none), F.coalesce(entries, none)).alias("history"))


def proposals(corrections: DataFrame, params: DataFrame) -> DataFrame:
    """``journal, step, param, action, value, n, papers``: what all five rules propose, in the order in which it is applied.

    ``value`` is JSON: a number, the stored list with new entries (sorted), the stored
    map with new ones. ``params``: a row a journal with ``mfd_conf_override,
    extra_boilerplate_patterns, heading_remap, postprocess_extras`` (an array of
    ``struct<replace, with>``). Ties of headings: of two new names for one the last in
    order stays.
    """
    strings, extras = "array<string>", "array<struct<replace:string,with:string>>"
    p = params.select("journal", *(F.col(c).alias(f"_{c}") for c in ("mfd_conf_override", "extra_boilerplate_patterns", "heading_remap", "postprocess_extras")))
    d = _tally(corrections).join(p, "journal", "left")
    texts, remap, have = F.coalesce("_extra_boilerplate_patterns", F.array().cast(strings)), F.coalesce("_heading_remap", F.create_map().cast("map<string,string>")), F.coalesce("_postprocess_extras", F.array().cast(extras))
    stored = lambda x: F.coalesce(F.try_element_at(remap, x["before"]) == x["after"], F.lit(False))
    d = d.withColumns({"base": F.coalesce("_mfd_conf_override", F.lit(BASE)), "texts": F.array_except("texts", texts), "headings": F.array_sort(F.filter("headings", lambda x: ~stored(x))), "characters": F.array_except(F.array_sort("characters"), have)})
    old = F.filter(F.map_entries(remap), lambda e: ~F.exists("headings", lambda x: x["before"] == e["key"]))
    last = F.filter("headings", lambda x, i: ~F.exists(F.slice("headings", i + 2, F.size("headings")), lambda y: y["before"] == x["before"]))
    merged = F.array_sort(F.concat(F.transform(old, lambda e: F.struct(e["key"].alias("before"), e["value"].alias("after"))), last))

    def made(step, param, action, value, n, least):
        one = F.struct(F.lit(step).alias("step"), F.lit(param).alias("param"), F.lit(action).alias("action"), F.to_json(F.struct(value.alias("value"))).alias("value"), n.cast("long").alias("n"))
        return F.when(n >= least, one)

    steps = F.array(
        made(1, "mfd_conf_override", "lower", F.round(F.col("base") - STEP, 4), F.col("added"), THRESHOLD),
        made(2, "mfd_conf_override", "raise", F.round(F.col("base") + STEP, 4), F.col("removed"), THRESHOLD),
        made(3, "extra_boilerplate_patterns", "add", F.sort_array(F.array_union("texts", texts)), F.size("texts"), 1),
        made(4, "heading_remap", "add", F.map_from_entries(merged), F.size("headings"), 1),
        made(5, "postprocess_extras", "add", F.concat(have, "characters"), F.size("characters"), 1),
    )
    return d.select("journal", F.inline(F.array_compact(steps)), "papers")


def _tally(corrections: DataFrame) -> DataFrame:
    """``journal, added, removed, texts, headings, characters, papers``: what all rules count, of changes made often enough; corrections are gone over once.

    A correction is of one kind, so it counts for one rule at most.
    """
    of = lambda step, a=None, b=None: F.struct(F.lit(step).alias("step"), (F.lit(None).cast("string") if a is None else a).alias("a"), (F.lit(None).cast("string") if b is None else b).alias("b"))
    before, after, kind = F.col("before"), F.col("after"), F.col("type")
    had, has = F.coalesce(before.rlike(FORMULA), F.lit(False)), F.coalesce(after.rlike(FORMULA), F.lit(False))
    formula = F.when(has & ~had, of(1)).when(had & ~has, of(2))
    text = tk.let(tk.strip(before), lambda x: F.when(x != "", of(3, x)))
    heading = tk.let(F.struct(tk.strip(before).alias("b"), tk.strip(after).alias("a")), lambda x: F.when((x["b"] != "") & (x["a"] != "") & (x["b"] != x["a"]), of(4, x["b"], x["a"])))
    differ = F.filter(F.arrays_zip(F.split(before, "").alias("f"), F.split(after, "").alias("t")), lambda x: x["f"] != x["t"])
    character = F.when((before != after) & (F.length(before) == F.length(after)), tk.let(differ, lambda x: F.when(F.size(x) == 1, of(5, x[0]["f"], x[0]["t"]))))
    key = F.when(kind == KINDS[1], formula).when(kind == KINDS[0], text).when(kind == KINDS[2], heading).when(kind == KINDS[4], character)
    n = corrections.select("journal", "paper_key", key.alias("key")).groupBy("journal", "key").agg(F.count("*").alias("n"), F.collect_set("paper_key").alias("papers"))
    step, often = F.col("key.step"), F.col("n") >= THRESHOLD
    listed = lambda k, a, *b: F.collect_list(F.when((step == k) & often, F.struct(F.col("key.a").alias(a), F.col("key.b").alias(*b)) if b else F.col("key.a")))
    return n.groupBy("journal").agg(
        F.sum(F.when(step == 1, F.col("n"))).alias("added"), F.sum(F.when(step == 2, F.col("n"))).alias("removed"), listed(3, "text").alias("texts"), listed(4, "before", "after").alias("headings"),
        listed(5, "replace", "with").alias("characters"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("papers")))).alias("papers"),
    )


def apply_proposals(params: DataFrame, proposed: DataFrame, date: Column) -> DataFrame:
    """``journal, mfd_conf_override, extra_boilerplate_patterns, heading_remap, postprocess_extras, history`` after all proposals.

    Each takes the place of the stored value in the order of its step, so of lower and
    raise the last counts; every change is added to the history with the value before it
    and after. Journals without parameters start from the defaults.
    """
    extras, entry = "array<struct<replace:string,with:string>>", "struct<date:string,param:string,old:string,new:string,reason:string,papers:array<string>>"
    steps = proposed.groupBy("journal").agg(F.array_sort(F.collect_list(F.struct("step", "param", "action", "value", "papers"))).alias("steps"))
    p = params.join(steps, "journal", "full_outer").withColumn("steps", F.coalesce("steps", F.array().cast("array<struct<step:int,param:string,action:string,value:string,papers:array<string>>>")))
    old = {"mfd_conf_override": F.col("mfd_conf_override"), "extra_boilerplate_patterns": F.coalesce("extra_boilerplate_patterns", F.array().cast("array<string>")), "heading_remap": F.coalesce("heading_remap", F.create_map().cast("map<string,string>")), "postprocess_extras": F.coalesce("postprocess_extras", F.array().cast(extras))}
    kinds = {"mfd_conf_override": "double", "extra_boilerplate_patterns": "array<string>", "heading_remap": "map<string,string>", "postprocess_extras": extras}
    of = lambda name: F.filter("steps", lambda s: s["param"] == name)
    now = {k: F.coalesce(F.from_json(F.try_element_at(of(k), F.lit(-1))["value"], f"struct<value:{kinds[k]}>")["value"], v) for k, v in old.items()}
    before = F.map_from_arrays(F.array(*(F.lit(k) for k in old)), F.array(*(F.to_json(F.struct(v.alias("value"))) for v in old.values())))

    def made(s, i):
        earlier = F.filter("steps", lambda t, j: (t["param"] == s["param"]) & (j < i))
        was = F.coalesce(F.try_element_at(earlier, F.lit(-1))["value"], before[s["param"]])
        return F.struct(date.cast("string").alias("date"), s["param"].alias("param"), was.alias("old"), s["value"].alias("new"), s["action"].alias("reason"), s["papers"].alias("papers"))

    none = F.array().cast(f"array<{entry}>")
    history = F.concat(F.coalesce("history", none) if "history" in params.columns else none, F.transform("steps", made))
    return p.select("journal", *(v.alias(k) for k, v in now.items()), history.alias("history"))
