"""The operators as queries over the given tables, with the columns their contracts state."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orrery.llm import conversation_trie, decontamination, language_id, language_model, lattice
from orrery.llm import periodic_runs, pieces, pii, secrets, simhash, substrings, token_counts
from orrery.llm import tool_calls
from orrery.llm.listed_digests import listed_digests
from orrery.llm.rows import table
from orrery.llm.running import running
from orrery.workspace import materialise


def op1_lattice(spark: SparkSession, folder: str) -> DataFrame:
    return lattice.near_duplicates(table(spark, folder, "embeddings"))


def op2_substrings(spark: SparkSession, folder: str) -> DataFrame:
    found = substrings.repeated_passages(table(spark, folder, "documents"))
    return found.select(
        "doc_id",
        "n_words",
        "n_removed",
        F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"),
    )


def op3_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("code"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op4_secrets(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, folder, "documents"), ["doc_id"])

    def spelt(spans):
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
        )

    def number(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    base = F.filter("spans", lambda s: s["kind"] != "random")
    return found.select(
        "doc_id",
        number("assign").alias("n_assign"),
        number("access").alias("n_access"),
        number("hex").alias("n_hex"),
        F.sha2(spelt(base).cast("binary"), 256).alias("base_sha256"),
        spelt(F.col("spans")).alias("spans"),
    )


def op5_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = language_id.fit(language_id.training_rows(docs))
    return language_id.predict(docs, model, ["doc_id"]).select(
        "doc_id",
        language_id.third_is_held_out(F.col("doc_id")).alias("held_out"),
        "lang_pred",
        "score",
    )


TOOL_SCHEMAS = {
    "answer": {
        "type": "object",
        "required": ["question", "turn"],
        "properties": {
            "question": {"type": "string", "minLength": 40},
            "turn": {"type": "integer", "minimum": 0},
            "after": {"type": "string"},
        },
        "additionalProperties": False,
    }
}


def op6_tool_calls(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations as given, and the same ones told as tool traffic.

    The given turns hold no calls, so in the second telling each user turn calls a tool
    with its text, pointing to the call before, and each assistant turn is the result of
    the turn before it; of every fourth conversation the results come in before the calls.
    """
    given = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    call = F.to_json(
        F.struct(
            F.array(
                F.struct(
                    F.concat(F.lit("call-"), "turn").alias("id"),
                    F.when(F.col("turn") % 5 == 4, "search").otherwise("answer").alias("name"),
                    F.struct(
                        F.col("text").alias("question"),
                        F.col("turn").alias("turn"),
                        F.when(
                            F.col("turn") >= 2,
                            F.struct(F.concat(F.lit("call-"), F.col("turn") - 2).alias("$ref")),
                        ).alias("after"),
                    ).alias("arguments"),
                )
            ).alias("tool_calls")
        )
    )
    result = F.to_json(
        F.struct(
            F.concat(F.lit("call-"), F.col("turn") - 1).alias("tool_call_id"),
            F.col("text").alias("content"),
        )
    )
    early = (F.col("conv_id") % 4 == 0) & (F.col("role") == "assistant")
    told = given.select(
        (-1 - F.col("conv_id")).alias("conv_id"),
        F.when(early, F.col("turn") - 2).otherwise(F.col("turn")).alias("turn"),
        "role",
        F.when(F.col("role") == "user", call)
        .when(F.col("role") == "assistant", result)
        .otherwise(F.col("text"))
        .alias("text"),
    )
    return tool_calls.link_tool_calls(given.union(told), TOOL_SCHEMAS)


def op7_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontamination.contamination(
        table(spark, folder, "documents"), table(spark, folder, "benchmark"), ["doc_id"]
    )
    ids = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ",").cast("binary"), 256).alias("items_sha256"),
        decontamination.is_contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"),
    )


def op8_pieces(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.tokenise(table(spark, folder, "documents"), ["doc_id"])


def op9_language_model(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    held_out = language_model.seventh_is_held_out(F.col("doc_id"))
    found = language_model.score_texts(
        docs.select("doc_id", "text"), F.col("doc_id").isNotNull() & ~held_out, ["doc_id"]
    )
    return found.select("doc_id", held_out.alias("held_out"), *found.columns[1:])


def op10_pii(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return pii.pseudonymise(docs).select(
        "doc_id", F.col("pseudonymised").alias("text"), "n_pii"
    )


def _number(conv: str) -> Column:
    return F.crc32(F.col(conv).cast("string").cast("binary")) % 9


def rebuilt_conversations(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns (conv_id, depth, digest, bytes) of all conversations rebuilt, and all conversations.

    Each begins with the first turns of the one whose number is its own less its remainder by 5.
    """
    own = conversation_trie.ordered_turns(turns)
    conversations = own.where("position = 1").select("conv_id")
    begun = conversations.select(
        "conv_id", (F.col("conv_id") - F.col("conv_id") % 5).alias("base"), _number("conv_id").alias("h")
    )
    first = own.where("position <= 8 and conv_id % 5 = 0").withColumnRenamed("conv_id", "base")
    begins = begun.join(first, "base").where("position <= h").select(own.columns)
    rest = own.where(F.col("position") > _number("conv_id"))
    placed = running(begins.union(rest), "conv_id", ["position"], ["one"], conversation_trie._ones)
    return placed.select("conv_id", F.col("one_run").alias("depth"), "digest", "bytes"), conversations


def op11_conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    nodes, last = conversation_trie.trie(*rebuilt_conversations(table(spark, folder, "conversations")))
    ends = materialise(listed_digests(last, ("key_a", "key_b"), "conv_id", "ends_sha256"), "ends")
    return materialise(nodes, "nodes").join(ends, ["key_a", "key_b"], "left").select(
        *["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves"],
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit(b""), 256)).alias("ends_sha256"),
    )


def op12_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    found = token_counts.count_tokens(table(spark, folder, "documents"), ["doc_id"])
    return found.withColumn("over_limit", F.col("n_tokens") > 2048)


_PERIOD = "substring_index(substring_index(spelt, ' ', at + p), ' ', -p)"
_PLANTED = f"""
concat(substring_index(spelt, ' ', at), if(at > 0, ' ', ''),
       substring_index(repeat(concat({_PERIOD}, ' '), cast(ceil((n - at) / p) as int)), ' ', n - at))"""


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, text): words of every tenth document by its number's checksum repeat from some word on.

    Words are cut out of the text as it is spelt with single blanks, without a string for each.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    spelt = F.trim(F.regexp_replace("text", r"[\x20\x09-\x0D]+", " "))
    told = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), F.when(h % 10 == 0, spelt).alias("spelt"))
    told = told.withColumn(
        "n", F.expr("if(spelt > '', octet_length(spelt) - octet_length(replace(spelt, ' ')) + 1, null)")
    )
    told = told.withColumn("at", F.expr("cast(g % n as int)"))
    told = told.withColumn("p", F.expr("cast(1 + floor((n - at) / (3 + g % 8)) as int)"))
    return told.select("doc_id", F.when(F.col("n") > 0, F.expr(_PLANTED)).otherwise(F.col("text")).alias("text"))


_GREATEST = """
aggregate(runs, cast(null as struct<start:bigint,length:bigint,period:bigint>),
          (best, r) -> if(best is null or r.length * best.period > best.length * r.period, r, best))"""


def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = periodic_runs.collapse_runs(with_planted_runs(table(spark, folder, "documents")), ["doc_id"])
    best = F.col("best")
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return found.withColumn("best", F.expr(_GREATEST)).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[best[c].alias(c) for c in ("start", "length", "period")],
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(
            F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), "").cast("binary"), 256
        ).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_lattice": op1_lattice,
    "op2_substrings": op2_substrings,
    "op3_simhash": op3_simhash,
    "op4_secrets": op4_secrets,
    "op5_language_id": op5_language_id,
    "op6_tool_calls": op6_tool_calls,
    "op7_decontamination": op7_decontamination,
    "op8_pieces": op8_pieces,
    "op9_language_model": op9_language_model,
    "op10_pii": op10_pii,
    "op11_conversation_trie": op11_conversation_trie,
    "op12_token_counts": op12_token_counts,
    "op13_periodic_runs": op13_periodic_runs,
}
