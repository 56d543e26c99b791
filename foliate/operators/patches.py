"""Reviewers' patches: which may be applied, and the final items that they give, with the origin of every field.

A patch meets its item by number, else by id, in two joins on equal keys.  Patches that are refused are rows with
their reasons; nothing that is stored is overwritten.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from foliate.functions import text as T

#: What a patch may do, and which items an export takes.
ACCEPT, BLOCK, HOLD = "accept_with_manual_patch", "block", "hold_for_review"
MODES = ("accepted_only", "accepted_plus_patched", "all_with_status")
_OPTIONS = "array<struct<key:string,text:string>>"


def _given(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit("")) != ""


def judge(items: DataFrame, patches: DataFrame, allow_accepted: bool = False) -> DataFrame:
    """``patches`` with question_id (the item that each is for), matched_by (number or id), errors and applied.

    ``items`` are (doc_id, seq, question_id, question_number, status); ``patches`` (doc_id, position, patch_id, question_number,
    action, question_text_raw, options of key and text, correct_answer_key, solution_text_raw, confirm_no_guessing,
    reviewer_notes).  Of several items with one number the last counts.  A patch without an item, one for an accepted
    item unless ``allow_accepted``, one without confirmation, notes or content, and unknown actions are refused.
    """
    one = F.struct("question_id", "status")
    by_number = items.where("question_number is not null").groupBy("doc_id", "question_number").agg(F.max_by(one, "seq").alias("_by_number"))
    by_id = items.groupBy("doc_id", F.col("question_id").alias("patch_id")).agg(F.max_by(one, "seq").alias("_by_id"))
    out = patches.drop("question_id", "matched_by", "errors", "applied").join(by_number, ["doc_id", "question_number"], "left").join(by_id, ["doc_id", "patch_id"], "left")
    out = out.withColumns({"_target": F.coalesce("_by_number", "_by_id"), "matched_by": F.when(F.col("_by_number").isNotNull(), "number").when(F.col("_by_id").isNotNull(), "id")})
    options = F.coalesce(F.size("options"), F.lit(0)) > 0
    content = _given("question_text_raw") | options | _given("correct_answer_key") | _given("solution_text_raw")
    unfit = {
        "confirm_no_guessing_required": ~F.coalesce("confirm_no_guessing", F.lit(False)),
        "reviewer_notes_required": T.strip(F.coalesce("reviewer_notes", F.lit(""))) == "",
        "manual_patch_requires_at_least_one_field": ~content,
        "correct_answer_key_requires_options_for_text_derivation": _given("correct_answer_key") & ~options,
    }
    action = F.coalesce("action", F.lit(""))
    none = F.array().cast("array<string>")
    errors = F.when(F.col("_target").isNull(), F.array(F.lit("target_question_not_found")))
    if not allow_accepted:
        errors = errors.when(F.col("_target.status") == "accepted", F.array(F.lit("cannot_patch_accepted_item_without_flag")))
    errors = errors.when(action.isin(BLOCK, HOLD), none).when(action == ACCEPT, F.array_compact(F.array(*(F.when(c, F.lit(name)) for name, c in unfit.items())))).otherwise(F.array(F.concat(F.lit("unknown_action:"), action)))
    out = out.withColumns({"question_id": F.col("_target.question_id"), "errors": errors})
    return out.withColumn("applied", F.size("errors") == 0).drop("_by_number", "_by_id", "_target")


def patch_counts(judged: DataFrame) -> DataFrame:
    """Each document's patches: applied, blocking, holding and refused."""
    did = lambda action: F.count_if(F.col("applied") & (F.col("action") == action))
    return judged.groupBy("doc_id").agg(F.count(F.lit(1)).alias("total"), did(ACCEPT).alias("applied"), did(BLOCK).alias("blocked"), did(HOLD).alias("held"), F.count_if(~F.col("applied")).alias("rejected"))


def final_export(items: DataFrame, judged: DataFrame, mode: str = "accepted_plus_patched") -> DataFrame:
    """The final items of an export: (doc_id, question_id, question_number, question_text_raw, options, answer_key, answer_text, solution_text,
    answer_source, export_status, issues, provenance, origins).

    ``items`` are (doc_id, seq, question_id, question_number, question_text_raw, options of key and text, answer_key, solution_text,
    grounded, gate, issues), ``judged`` the :func:`judge` of patches.  An item that the gate finds accepted_safe is taken as it is.
    In accepted_plus_patched each other number that none of these has is taken where a patch by number was applied, as its last
    patch leaves it: fields that the patch gives replace the item's.  all_with_status takes every item
    unpatched.  ``origins`` names for text, options, answer and solution the patch or ``bound``.
    """
    base = items.select("doc_id", "seq", "question_id", "question_number", "question_text_raw", F.coalesce(F.transform("options", lambda o: F.struct(o["key"].alias("key"), o["text"].alias("text"))), F.array().cast(_OPTIONS)).cast(_OPTIONS).alias("options"), "answer_key", "solution_text", "grounded", "gate", "issues")
    if mode != "accepted_plus_patched":
        chosen = base.where("gate = 'accepted_safe'") if mode == "accepted_only" else base
        out = chosen.withColumn("_p", F.lit(None).cast("struct<patch_id:string,text:string,options:array<struct<key:string,text:string>>,key:string,solution:string>"))
    else:
        fields = F.struct("patch_id", F.col("question_text_raw").alias("text"), F.transform("options", lambda o: F.struct(o["key"].alias("key"), o["text"].alias("text"))).cast(_OPTIONS).alias("options"), F.col("correct_answer_key").alias("key"), F.col("solution_text_raw").alias("solution"))
        manual = judged.where((F.col("action") == ACCEPT) & F.col("applied") & (F.col("matched_by") == "number"))
        last = manual.groupBy("doc_id", "question_id").agg(F.max_by(fields, "position").alias("_p"))
        safe = F.max(F.col("gate") == "accepted_safe").over(W.partitionBy("doc_id", "question_number"))
        out = base.withColumn("_safe", safe).join(last, ["doc_id", "question_id"], "left")
        out = out.where((F.col("gate") == "accepted_safe") | (F.col("_p").isNotNull() & ~F.coalesce("_safe", F.lit(False))))
        out = out.withColumn("_p", F.when(F.col("gate") != "accepted_safe", F.col("_p")))
    gave = lambda f: F.coalesce(F.col(f"_p.{f}"), F.lit("")) != ""
    listed = F.coalesce(F.size("_p.options"), F.lit(0)) > 0
    pick = lambda gave_, f, own: F.when(gave_, F.col(f"_p.{f}")).otherwise(F.col(own))
    from_ = lambda gave_, name: F.concat(F.lit(f"{name}="), F.when(gave_, F.col("_p.patch_id")).otherwise("bound"))
    out = out.withColumn("origins", F.array(from_(gave("text"), "text"), from_(listed, "options"), from_(gave("key"), "answer"), from_(gave("solution"), "solution")))
    out = out.withColumns({"question_text_raw": pick(gave("text"), "text", "question_text_raw"), "options": pick(listed, "options", "options"), "answer_key": T.answer_key(pick(gave("key"), "key", "answer_key")), "solution_text": pick(gave("solution"), "solution", "solution_text")})
    told = F.get(F.filter("options", lambda o: (T.answer_key(o["key"]) == F.col("answer_key")) & (T.strip(o["text"]) != "")), F.lit(0))
    out = out.withColumn("answer_text", T.strip(told["text"]))
    patched, sourced = F.col("_p").isNotNull(), F.col("answer_key").isNotNull() & F.coalesce("grounded", F.lit(False))
    lost = F.when(F.col("answer_key").isNotNull() & F.col("answer_text").isNull(), F.array(F.lit("correct_answer_text_unavailable"))).otherwise(F.array().cast("array<string>"))
    status = F.when(patched | (F.col("gate") == "accepted_safe"), "ready_for_pattern_input").when(F.col("gate") == "blocked", BLOCK + "ed").otherwise(HOLD)
    names = F.when(patched, F.array(F.lit("semantic_binding"), F.lit("manual_patch"))).when(sourced, F.array(F.lit("semantic_binding"), F.lit("semantic_repair"))).otherwise(F.array(F.lit("semantic_binding")))
    source = F.when(patched, "manual_review").when(sourced, "source_grounded").otherwise("unavailable")
    return out.select("doc_id", "question_id", "question_number", "question_text_raw", "options", "answer_key", "answer_text", "solution_text", source.alias("answer_source"), status.alias("export_status"), F.array_distinct(F.concat("issues", lost)).alias("issues"), names.alias("provenance"), "origins")
