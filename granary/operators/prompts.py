"""Relevant flags, prompt templates, routing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from granary.functions import text as X


def relevant_flags(command: Column, flags: Column, strict: bool = False) -> Column:
    """The flags that the command names, by ` --option` or ` -short`, and those with a default. The test is for a beginning, so a longer option also counts. strict: an empty option is an error."""
    def keep(f: Column) -> Column:
        option = F.coalesce(f["option"], F.lit(""))
        if strict:
            option = F.when(option == "", F.raise_error(F.lit("a flag without an option"))).otherwise(option)
        short = F.coalesce(X.strip(f["short"]), F.lit(""))
        return (option != "") & F.contains(command, F.concat(F.lit(" --"), option)) | (short != "") & F.contains(command, F.concat(F.lit(" -"), short)) | (F.coalesce(f["default_value"], F.lit("")) != "")

    return F.filter(F.coalesce(flags, F.array().cast("array<struct<option: string, short: string, default_value: string, description: string>>")), keep)


def example_text(reasoned: bool) -> Column:
    head = F.concat(F.lit("General idea: "), F.col("general_form"))
    if reasoned:
        return F.concat(head, F.lit("\\Instruction: "), F.col("instruction"), F.lit("\nCommand: "), F.col("command"), F.lit("\nChain of Thought: "), F.col("chain_of_thought"))
    return F.concat(head, F.lit("\nCommand: "), F.col("command"), F.lit("\nInstruction: "), F.col("instruction"))


def examples_block(picked: DataFrame, examples: DataFrame, reasoned: bool) -> DataFrame:
    """id, examples: the texts of the picked examples in order, joined by blank lines."""
    e = examples.select("example_id", example_text(reasoned).alias("text"))
    return picked.join(F.broadcast(e) if e.count() <= 1000 else e, "example_id").groupBy("id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "text"))), lambda x: x["text"]), "\n\n").alias("examples"))


def reasoning_prompt(objective: Column, question: Column, command: Column, examples: Column, docs: Column, has_flags: Column) -> Column:
    """docs: JSON of the relevant documentation, given only where there are relevant flags."""
    say = lambda c: F.coalesce(c, F.lit("None"))
    about = F.when(has_flags, F.concat(F.lit("Do not comment about flags that could be used\nIf a flag is not specified in the command, consider the default found in the docs\nTo understand the flags use the documentation JSON format here: "), docs, F.lit("\n\n"))).otherwise("")
    return F.concat(F.lit("Generate the chain of thought process for the given command, based on the general idea and the instruction.\n\n"), examples, F.lit("\n\nGeneral idea: "), say(objective), F.lit("\nInstruction: "), say(question), F.lit("\nCommand: "), say(command), F.lit("\n"), about, F.lit("Chain of Thought: "))


def instruction_prompt(objective: Column, command: Column, examples: Column, specific: Column) -> Column:
    say = lambda c: F.coalesce(c, F.lit("None"))
    lead = F.when(specific, "For a given command and the general idea, provide in instruction for which the command is the answer, please include the parameters in your instruction").otherwise("For a given command, provide in instruction for which the command is the answer, please give a general instruction as your answer")
    return F.concat(lead, F.lit("\n\n"), examples, F.lit("\n\nGeneral idea: "), say(objective), F.lit("\nCommand: "), say(command), F.lit("\nInstruction: "))


def label_text(steps: Column, code: Column) -> Column:
    return F.concat(F.lit("#Steps:\n"), steps, F.lit("\n#Code:\n"), code)


def route(reply: Column) -> Column:
    """0 for a command, 1 for a question about the domain, 2 for anything else."""
    return F.when(F.contains(reply, F.lit("0")), 0).when(F.contains(reply, F.lit("1")), 1).otherwise(2)


def routed_prompt(prompt: Column, kind: Column, start: str = "### Answer:", documentation: Column | None = None) -> Column:
    """The prompt of a route; for questions with documentation, its text before the question."""
    plain = F.concat(F.lit("[INST] Answer the following question: "), prompt, F.lit(" [/INST]\nAnswer: "))
    asked = plain if documentation is None else F.when(documentation.isNull(), plain).otherwise(
        F.concat(F.lit("You are a helpful kubernetes professional. [INST] Use the following documentation, if it is relevant to answer the question below. [/INST]\nDocumentation: "), documentation, F.lit(" </s>\n<s> [INST] Answer the following question: "), prompt, F.lit(" [/INST]\nAnswer:\n\n"))
    )
    return F.when(kind == 0, F.concat(F.lit("[INST] "), prompt, F.lit("\n Lets think step by step. [/INST] " + start))).when(kind == 1, asked).otherwise(F.concat(F.lit("[INST] "), prompt, F.lit(" [/INST]")))


def fan_out(asked: DataFrame, retrievers: dict[str, DataFrame | None]) -> DataFrame:
    """query_id, prompt, retriever, full_prompt, trace: each question once for every retriever. asked: query_id, prompt; a retriever's table: query_id, context; None asks without documentation.

    A question for which the search has no result gets empty documentation, one that the index doesn't know goes without. trace: the steps in Markdown, for questions with documentation.
    """
    out = None
    for name, found in retrievers.items():
        rows = asked.withColumn("retriever", F.lit(name))
        if found is None:
            rows = rows.withColumn("context", F.lit(None).cast("string"))
        else:
            rows = rows.join(found.select("query_id", "context"), "query_id", "left")
            rows = rows.withColumn("context", F.coalesce("context", F.lit(""))) if name == "web" else rows
        out = rows if out is None else out.unionByName(rows)
    step = lambda n, title: F.lit(f"### Step {n}: {title}  \n\n")
    asked_for = F.concat(F.lit("Documentation: [RETRIEVED_RESULTS] [INST] Answer the following question: "), F.col("prompt"), F.lit(" [/INST]\nAnswer:"))
    trace = F.when(F.col("context").isNull(), "").otherwise(F.concat(step(1, "Preparing prompt for additional documentation"), step(2, "Retrieving documentation"), X.markdown(F.col("context")), F.lit("  \n\n"), step(3, "Creating full prompt given to model"), asked_for))
    return out.select("query_id", "prompt", "retriever", routed_prompt(F.col("prompt"), F.lit(1), documentation=F.col("context")).alias("full_prompt"), trace.alias("trace"))
