"""The driver queries: one per user-visible operator or small family.

Each takes ``(spark, sf_dir)`` and returns a DataFrame over the rendered views
of that directory (see :mod:`.views`).  The plans are lazy; only the queries of
file sinks write when they are built, and read back what they wrote.  Column names match the SQL
oracles in :mod:`.oracle`.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fixed import CLM_VAL_CAP
from ..operators import corpus, grid, localization, logs, mix, results, score
from ..operators.blocks import extract_blocks, strip_comments, structured_blocks
from ..operators.chunks import extract_blocks_by_lines, split_entries_by_lines
from ..operators.pairs import instruction_pairs
from ..session import ensure_checkpoint_dir, write_once
from ..sources.files import read_jsonl, read_reports, scan_scripts, write_jsonl, write_reports
from ..sources.lines import scan_lines, scan_localization_lines, text_lines
from ..sources.results_log import append_experiments, append_results, read_experiments, read_results
from ..streaming import running_log
from .views import Views

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn):
    QUERIES[fn.__name__.removeprefix("q_")] = fn
    return fn


def _v(spark, sf_dir) -> Views:
    return Views(spark, sf_dir)


# ---- scripts -------------------------------------------------------------

@query
def q_corpus_raw(spark, sf_dir):
    return corpus.raw_corpus(_v(spark, sf_dir).view("v_scripts"))


@query
def q_corpus_clm(spark, sf_dir):
    return corpus.clm_documents(corpus.raw_corpus(_v(spark, sf_dir).view("v_scripts")))


@query
def q_strip_comments(spark, sf_dir):
    return _v(spark, sf_dir).view("v_scripts").select("path", strip_comments("text").alias("text"))


@query
def q_blocks_top(spark, sf_dir):
    s = _v(spark, sf_dir).view("v_scripts")
    return extract_blocks(s.select("path", strip_comments("text").alias("text")))


@query
def q_blocks_headers(spark, sf_dir):
    return extract_blocks(_v(spark, sf_dir).view("v_scripts"))


def _structured(spark, sf_dir) -> DataFrame:
    return structured_blocks(_v(spark, sf_dir).view("v_scripts"))


@query
def q_blocks_structured(spark, sf_dir):
    return _structured(spark, sf_dir).drop("cat_ord")


@query
def q_category_counts(spark, sf_dir):
    return _structured(spark, sf_dir).groupBy("category").agg(F.count(F.lit(1)).alias("n")) \
        .orderBy(F.desc("n"), "category")


def _loc(spark, sf_dir, view="v_loc") -> DataFrame:
    v = _v(spark, sf_dir)
    return localization.parse_loc(v.view(view))


@query
def q_pairs_sft(spark, sf_dir):
    loc = localization.latest_loc(_loc(spark, sf_dir))
    return instruction_pairs(_structured(spark, sf_dir), loc)


@query
def q_loc_entries(spark, sf_dir):
    return _loc(spark, sf_dir).select("path", "ln", "key", "value")


@query
def q_loc_latest(spark, sf_dir):
    return localization.latest_loc(_loc(spark, sf_dir))


@query
def q_loc_describe(spark, sf_dir):
    d = localization.descriptions(localization.latest_loc(_loc(spark, sf_dir)))
    b = _structured(spark, sf_dir)
    fallback = F.concat(F.lit("is a "), F.col("category"), F.lit(" definition"))
    return (b.join(d, b["name"] == d["base"], "left")
             .select("source_file", "ln", "category", "name",
                     F.coalesce(F.col("loc_desc"), fallback).alias("loc_desc")))


@query
def q_pairs_loc(spark, sf_dir):
    return localization.loc_pairs(localization.latest_loc(_loc(spark, sf_dir, "v_loc_groups")))


@query
def q_pairs_loc_split(spark, sf_dir):
    """Key groups of any size: larger ones dealt into parts, no key lost."""
    return localization.loc_pairs(localization.latest_loc(_loc(spark, sf_dir, "v_loc_groups")), oversize="split")


# ---- engine logs ---------------------------------------------------------

@query
def q_engine_entries(spark, sf_dir):
    return logs.log_entries(_v(spark, sf_dir).view("v_logs"))


@query
def q_datatype_entries(spark, sf_dir):
    return logs.data_type_entries(_v(spark, sf_dir).view("v_types"))


@query
def q_engine_counts(spark, sf_dir):
    v = _v(spark, sf_dir)
    return logs.entry_counts(v.view("v_logs"), v.view("v_types"))


@query
def q_pairs_engine(spark, sf_dir):
    v = _v(spark, sf_dir)
    return logs.engine_reference(v.view("v_logs"), v.view("v_log_files"), v.view("v_types"))


# ---- files read split by split ---------------------------------------------

def _files_of(view: DataFrame, path: str, spark, folder: str = "", order: list[str] | None = None, text: str = "text") -> str:
    """A view's texts as text files in the shared folder, one directory per name; the root."""
    root = _scratch(spark, "files")
    named = view.select(F.col(path).alias("name"), *(order or []), F.col(text).alias("value"))
    if order:
        named = named.repartition("name").sortWithinPartitions("name", *order).drop(*order)
    named.write.partitionBy("name").text(f"{root}/{folder}")
    return root


def _with_file(rows: DataFrame) -> DataFrame:
    return rows.withColumn("file", F.regexp_extract("path", "name=([^/]*)/", 1)).drop("path")


@query
def q_scripts_scan(spark, sf_dir):
    """Script files written below category, other and skipped directories, scanned,
    filtered: lines, characters and a digest of the lines per directory."""
    root = _scratch(spark, "game")
    scripts = _v(spark, sf_dir).view("v_scripts").withColumn("dir", F.regexp_extract("path", "^(.*)/", 1))
    for d in ("events", "common/decisions", "common/traits", "common/scripted_effects", "misc", "tools"):
        scripts.where(F.col("dir") == d).select("text").write.text(f"{root}/{d}")
    spark.range(1).select(F.lit(" \t ")).write.text(f"{root}/blank")
    kept = corpus.raw_corpus(scan_scripts(spark, root))
    lines = kept.select(F.regexp_extract("path", "^(.*)/", 1).alias("dir"), "category", F.explode(F.split("text", "\n", -1)).alias("line"))
    digest = F.conv(F.substring(F.md5("line"), 1, 8), 16, 10).cast("long")
    return lines.where("line <> ''").groupBy("dir", "category").agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum(F.length("line").cast("long")).alias("chars"), F.sum(digest).alias("digest"))


@query
def q_blocks_by_lines(spark, sf_dir):
    """Blocks found over chunks of 16 lines: strings, blocks and headers cross them."""
    return extract_blocks_by_lines(text_lines(_v(spark, sf_dir).view("v_scripts")), width=16)


@query
def q_blocks_headers_by_lines(spark, sf_dir):
    return extract_blocks_by_lines(text_lines(_v(spark, sf_dir).view("v_scripts")), keep_comments=True, width=16)


@query
def q_engine_entries_scan(spark, sf_dir):
    """Engine logs written as files and read by lines, split by split."""
    root = _files_of(_v(spark, sf_dir).view("v_logs"), "file", spark)
    return logs.named_entries(_with_file(split_entries_by_lines(scan_lines(spark, root, root), 4)), logs.log_entry_name)


@query
def q_datatype_entries_scan(spark, sf_dir):
    root = _files_of(_v(spark, sf_dir).view("v_types"), "file", spark)
    return logs.named_entries(_with_file(split_entries_by_lines(scan_lines(spark, root, root), 5)), logs.data_type_name)


@query
def q_loc_latest_scan(spark, sf_dir):
    """Localization files written in line order and read by lines; last key wins."""
    root = _files_of(_v(spark, sf_dir).view("v_loc"), "path", spark, "localization/english", ["ln"], "line")
    return localization.latest_loc(localization.parse_loc(scan_localization_lines(spark, root, glob="*")))


# ---- scoring -------------------------------------------------------------

def _scored(spark, sf_dir, how="inner", max_ord=None) -> DataFrame:
    v = _v(spark, sf_dir)
    prompts = v.view("v_prompts")
    if max_ord is not None:
        prompts = prompts.where(F.col("ord") < max_ord)
    return score.score_outputs(v.view("v_outputs"), prompts, how)


@query
def q_score_rows(spark, sf_dir):
    return _scored(spark, sf_dir)


@query
def q_score_summary(spark, sf_dir):
    return score.summarize(_scored(spark, sf_dir, "left"), ["run_id"])


@query
def q_score_rating(spark, sf_dir):
    return _scored(spark, sf_dir).select("run_id", "prompt_id", "total_score",
                                         score.rating("total_score").alias("rating"))


@query
def q_score_quick(spark, sf_dir):
    return score.summarize(_scored(spark, sf_dir, "left", max_ord=3), ["run_id"])


@query
def q_score_compare(spark, sf_dir):
    s = score.summarize(_scored(spark, sf_dir, "left"), ["run_id"]).drop("num_prompts")
    a = s.select(F.col("run_id").alias("run_a"), (F.col("run_id") + 1).alias("run_b"), *s.columns[1:])
    b = s.select((F.col("run_id") - 1).alias("run_a"), F.col("run_id").alias("run_b"), *s.columns[1:])
    return score.compare_runs(a, b, ["run_a", "run_b"])


@query
def q_score_benchmark(spark, sf_dir):
    """Outputs scored against the fixed benchmark prompts."""
    v = _v(spark, sf_dir)
    prompts = score.eval_prompts(spark)
    out = v.view("v_outputs").withColumn("ord", F.pmod("run_id", F.lit(8)).cast("int")).join(
        prompts.select("ord", F.col("prompt_id").alias("p")), "ord").select(
        F.concat_ws("|", F.col("run_id").cast("string"), "prompt_id").alias("run"), F.col("p").alias("prompt_id"), "text")
    return score.score_outputs(out, prompts)


@query
def q_eval_report_json(spark, sf_dir):
    """Reports written as JSON lines, read back and taken apart: one row per scored prompt."""
    v = _v(spark, sf_dir)
    scored = _scored(spark, sf_dir, "left")
    rep = score.eval_report(score.summarize(scored, ["run_id"]), score.per_prompt_list(scored, ["run_id"]), v.view("v_outputs"),
                            ["run_id"], F.lit(1700000000).cast("long") + F.col("run_id"))
    path = _scratch(spark, "reports")
    write_reports(rep, path)
    back = score.read_report_metrics(read_reports(spark, path).withColumn("x", F.from_json(
        "report", "timestamp long, metrics struct<per_prompt:array<struct<prompt_id:string,total_score:double,keywords_found:int,"
                  "brace_balanced:boolean>>>, outputs map<string,string>")))
    return back.select(F.col("x.timestamp").alias("timestamp"), "val_score", "num_prompts",
                       F.size("x.outputs").alias("outputs_n"), F.col("x.outputs").alias("outputs"),
                       F.explode_outer("x.metrics.per_prompt").alias("p")).select(
        "timestamp", "val_score", "num_prompts", "outputs_n", F.col("p.prompt_id").alias("prompt_id"),
        F.col("p.total_score").alias("total_score"), F.col("p.keywords_found").alias("keywords_found"),
        F.col("p.brace_balanced").alias("brace_balanced"),
        F.md5(F.element_at("outputs", F.col("p.prompt_id"))).alias("output_md5"))


# ---- experiment log ------------------------------------------------------

def _log(spark, sf_dir) -> DataFrame:
    return results.normalise_log(_v(spark, sf_dir).view("v_log"))


@query
def q_log_normalise(spark, sf_dir):
    return _log(spark, sf_dir)


@query
def q_log_kept(spark, sf_dir):
    return results.kept_with_index(_log(spark, sf_dir)).select("idx", "seq", "val_score", "memory_gb", "description")


@query
def q_log_status_counts(spark, sf_dir):
    return results.status_counts(_log(spark, sf_dir))


@query
def q_log_keep_rate(spark, sf_dir):
    return results.keep_rate(_log(spark, sf_dir))


@query
def q_log_running_best(spark, sf_dir):
    return results.running_best(_log(spark, sf_dir)).select("idx", "seq", "val_score", "running_best", "baseline")


@query
def q_log_hits(spark, sf_dir):
    return results.hits(_log(spark, sf_dir)).select("rank", "seq", "val_score", "prev_score", "delta", "description")


@query
def q_log_hits_total(spark, sf_dir):
    return results.total_gain(results.gains(_log(spark, sf_dir)))


@query
def q_log_summary(spark, sf_dir):
    return results.summary(_log(spark, sf_dir))


@query
def q_log_labels(spark, sf_dir):
    return results.frontier_labels(_log(spark, sf_dir))


# ---- sweep results -------------------------------------------------------

def _results(spark, sf_dir) -> DataFrame:
    return results.typed_results(_v(spark, sf_dir).view("v_results"))


@query
def q_log_rows_format(spark, sf_dir):
    return results.format_result_rows(_results(spark, sf_dir))


@query
def q_results_sorted_limit(spark, sf_dir):
    return results.sorted_results(_results(spark, sf_dir).drop("ts"), "val_score", 50)


@query
def q_results_best(spark, sf_dir):
    return results.best_config(_results(spark, sf_dir))


@query
def q_results_status(spark, sf_dir):
    return results.results_status(_results(spark, sf_dir))


@query
def q_sweep_new_best(spark, sf_dir):
    return results.new_best_flags(_results(spark, sf_dir))


@query
def q_sweep_ranking(spark, sf_dir):
    return results.ranking(_results(spark, sf_dir))


@query
def q_sweep_summary(spark, sf_dir):
    return results.sweep_summary(_results(spark, sf_dir))


@query
def q_run_metrics_rows(spark, sf_dir):
    r = _results(spark, sf_dir)
    # settings of a run, from its number: some known keys, some not
    own = F.expr("""map('LORA_R', cast(seq % 5 * 16 + 16 as string), 'LEARNING_RATE', concat('0.00', cast(seq % 9 + 1 as string)),
                        'NUM_EPOCHS', cast(seq % 3 + 1 as string), 'UNKNOWN', 'x')""")
    over = F.when(F.col("seq") % 2 == 0, own).otherwise(F.create_map().cast("map<string,string>"))
    return results.run_metrics(r, over, {"peak_vram_mb": F.round(F.col("elapsed_s") * 2, 1), "num_prompts": F.lit(8)})


@query
def q_results_log_round_trip(spark, sf_dir):
    """Appended in two jobs of several tasks, read back in log order."""
    path = _scratch(spark, "results")
    r = _results(spark, sf_dir)
    append_results(r.where("seq % 2 = 0").repartition(5), path)
    append_results(r.where("seq % 2 = 1").repartition(3), path)
    return read_results(spark, path).select("seq", "timestamp", "val_score", "syntax", "keyword", "structure", "status",
                                            "elapsed_s", "config")


@query
def q_experiment_log_read(spark, sf_dir):
    path = _scratch(spark, "experiments")
    append_experiments(_v(spark, sf_dir).view("v_log").repartition(4), path)
    return read_experiments(spark, path)


def _appended(rows, append, what) -> str:
    """A log that grows by three appends, each taken in when it is there; the state's folder."""
    spark = rows.sparkSession
    log, state = _scratch(spark, "log"), _scratch(spark, "state")
    for part in ("seq < 500", "seq between 500 and 2999", "seq >= 3000"):
        append(rows.where(part).repartition(3), log)
        running_log.extend(spark, log, state, what)
    return state


@query
def q_log_running_best_appended(spark, sf_dir):
    """Running best of a growing log: every append reads its own files alone."""
    state = _appended(_v(spark, sf_dir).view("v_log"), append_experiments, running_log.experiments())
    return running_log.running_best(spark, state).select("idx", "seq", "val_score", "running_best", "baseline")


@query
def q_log_hits_total_appended(spark, sf_dir):
    state = _appended(_v(spark, sf_dir).view("v_log"), append_experiments, running_log.kept_gains())
    return results.total_gain(running_log.running_gains(spark, state))


@query
def q_sweep_new_best_appended(spark, sf_dir):
    state = _appended(_results(spark, sf_dir), append_results, running_log.sweep())
    return running_log.new_best_flags(spark, state)


@query
def q_sweep_status_appended(spark, sf_dir):
    """Status, best config and summary from the batches' summaries alone."""
    state = _appended(_results(spark, sf_dir), append_results, running_log.sweep())
    return running_log.sweep_status(spark, state)


# ---- split and mix -------------------------------------------------------

def _scratch(spark, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _records(spark, sf_dir) -> DataFrame:
    """All instruction records, written once: the splits read their keys several times."""
    v = _v(spark, sf_dir)
    scripts = instruction_pairs(_structured(spark, sf_dir), localization.latest_loc(_loc(spark, sf_dir)))
    loc = localization.loc_pairs(localization.latest_loc(_loc(spark, sf_dir, "v_loc_groups")))
    engine = logs.engine_reference(v.view("v_logs"), v.view("v_log_files"), v.view("v_types"))
    return write_once(mix.instruction_records(scripts, loc, engine, v.view("v_sft")), "records")


def _mixed(spark, sf_dir, ratio, val_cap=None) -> DataFrame:
    return mix.mix_datasets(_records(spark, sf_dir), _v(spark, sf_dir).view("v_clm"), ratio, val_cap=val_cap)


@query
def q_sft_split(spark, sf_dir):
    return mix.split_train_val(_records(spark, sf_dir), "key").select("key", "pos", "split")


@query
def q_clm_split(spark, sf_dir):
    return mix.split_train_val(_v(spark, sf_dir).view("v_clm"), "doc_id").select("doc_id", "pos", "split")


@query
def q_mix_sample(spark, sf_dir):
    """The sampled documents in shuffled order: positions of the sample alone."""
    m = _mixed(spark, sf_dir, 0.2).where("kind = 'clm' and split = 'train'").select("key")
    return mix.shuffle_positions(m, "key", out="sample_pos").select(F.col("key").cast("long").alias("doc_id"), "sample_pos")


def _mix_counts(m: DataFrame) -> DataFrame:
    return m.groupBy("kind", "split").agg(F.count(F.lit(1)).alias("n"))


@query
def q_mix_counts(spark, sf_dir):
    return _mix_counts(_mixed(spark, sf_dir, 0.2, CLM_VAL_CAP))


@query
def q_mix_counts_uncapped(spark, sf_dir):
    return _mix_counts(_mixed(spark, sf_dir, 0.2))


@query
def q_mix_counts_sft_only(spark, sf_dir):
    return _mix_counts(_mixed(spark, sf_dir, 0.0))


@query
def q_train_text(spark, sf_dir):
    m = _mixed(spark, sf_dir, 0.2, CLM_VAL_CAP)
    return m.select("split", "key", mix.training_text(m).alias("text"))


@query
def q_dataset_stats(spark, sf_dir):
    """Records and MB of text of the six datasets."""
    v = _v(spark, sf_dir)
    raw = corpus.raw_corpus(v.view("v_scripts"))
    blocks = _structured(spark, sf_dir)
    pair = F.octet_length("instruction") + F.octet_length("completion")
    sets = [("raw_corpus", raw, F.octet_length("text")),
            ("structured_blocks", blocks, F.octet_length("code")),
            ("instruction_pairs", instruction_pairs(blocks, localization.latest_loc(_loc(spark, sf_dir))), pair),
            ("clm_dataset", corpus.clm_documents(raw), F.octet_length("text")),
            ("loc_pairs", localization.loc_pairs(localization.latest_loc(_loc(spark, sf_dir, "v_loc_groups"))), pair),
            ("engine_reference", logs.engine_reference(v.view("v_logs"), v.view("v_log_files"), v.view("v_types")), pair)]
    rows = [df.agg(F.count(F.lit(1)).alias("records"), F.sum(size.cast("long")).alias("bytes"))
            .select(F.lit(name).alias("dataset"), "records", "bytes") for name, df, size in sets]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out.select("dataset", "records", F.round(F.col("bytes") / F.lit(1048576.0), 1).alias("mb"))


@query
def q_jsonl_round_trip(spark, sf_dir):
    """Localization pairs written as JSON lines and read with a schema."""
    path = _scratch(spark, "jsonl")
    pairs = localization.loc_pairs(localization.latest_loc(_loc(spark, sf_dir, "v_loc_groups")))
    write_jsonl(pairs, path)
    return read_jsonl(spark, path, "system string, instruction string, completion string, category string, name string")


@query
def q_first_combos(spark, sf_dir):
    """The first 3 combinations of every grid."""
    e = grid.expand_grid(_grids(spark, sf_dir), "grid", max_experiments=3)
    return e.select("grid_id", "ordinal", grid.combo_json("combo").alias("config"))


# ---- grids ---------------------------------------------------------------

def _grids(spark, sf_dir) -> DataFrame:
    g = _v(spark, sf_dir).view("v_grids")
    per_key = g.groupBy("grid_id", "key").agg(F.array_sort(F.collect_set("value")).alias("vals"))
    as_json = per_key.groupBy("grid_id").agg(
        F.to_json(F.map_from_entries(F.collect_list(F.struct("key", "vals")))).alias("grid_json"))
    return as_json.select("grid_id", grid.parse_grid("grid_json").alias("grid"))


@query
def q_grid_expand(spark, sf_dir):
    e = grid.expand_grid(_grids(spark, sf_dir), "grid")
    return e.select("grid_id", "ordinal", grid.combo_json("combo").alias("config"))


@query
def q_grid_estimate(spark, sf_dir):
    g = _grids(spark, sf_dir).select("grid_id", grid.grid_size("grid").alias("total"))
    return g.select("grid_id", "total", grid.estimate_minutes("total").alias("est_minutes"))


@query
def q_config_resolve(spark, sf_dir):
    e = grid.expand_grid(_grids(spark, sf_dir), "grid")
    cfg = grid.resolve_config(F.map_from_entries("combo"))
    return e.select("grid_id", "ordinal", F.explode(cfg).alias("key", "value"))
