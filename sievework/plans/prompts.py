"""Prompts of the stages as columns: generation from seeds, grading, correspondence, test cases, repair, solving."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sievework.functions import text as T

#: What a grader is asked for, in order.
RUBRIC = {
    "problem_quality": "Is the problem stated clearly, completely and without contradiction?",
    "solution_completeness": "Does the solution contain every step from statement to answer?",
    "solution_quality": "Is every step of the solution right?",
    "test_case_quality": "Do the test cases cover the function's behaviour, and are their outputs right?",
}
SEED_RUBRIC = {"output_seed_correspondence": "Does the problem keep to the subject and difficulty of its seed?"}
MOST_SYSTEM = 2000


def or_empty(value: Column) -> Column:
    return F.coalesce(value, F.lit(""))


def seed_text(problem: Column, solution: Column, example: Column | None = None) -> Column:
    """A seed as text: problem and solution, or the example alone."""
    both = F.concat(F.lit("Problem: "), or_empty(problem), F.lit("\nSolution: "), or_empty(solution))
    return both if example is None else F.coalesce(example, both)


def adapted(system: Column, seed_type: Column, seed: Column) -> Column:
    """Asks for a new problem made from a seed; examples are a model of style only."""
    kind = F.when(seed_type == "example", "Use the example below as a model of form; choose another subject.").otherwise("Adapt the problem and solution below into a new problem with one answer.")
    return F.concat(or_empty(system), F.lit("\n\n"), kind, F.lit("\n\n"), seed)


def shown_cases(cases: Column) -> Column:
    """Test cases as lines "1. inputs -> output"; "none" without any. ``cases``: array<struct<inputs, output>>."""
    line = lambda c, i: F.concat((i + 1).cast("string"), F.lit(". "), or_empty(c["inputs"]), F.lit(" -> "), F.coalesce(c["output"], F.lit("?")))
    return F.when(F.coalesce(F.size(cases), F.lit(0)) > 0, F.array_join(F.transform(cases, line), "\n")).otherwise("none")


def grading(statement: Column, solution: Column, answer: Column, code: Column, cases: Column, seed: Column | None = None) -> Column:
    """The rubric for one problem, answered as JSON; with a seed (where it is not null) its correspondence is graded too."""
    asked = "\n".join(f"- {k}: {v}" for k, v in RUBRIC.items())
    more = "\n".join(f"- {k}: {v}" for k, v in SEED_RUBRIC.items())
    body = F.concat(F.lit("\n\nPROBLEM\n"), or_empty(statement), F.lit("\n\nSOLUTION\n"), or_empty(solution), F.lit("\n\nANSWER\n"), or_empty(answer), F.lit("\n\nCODE\n"), or_empty(code), F.lit("\n\nTEST CASES\n"), cases)
    head = "Grade from 0 to 100, each with a short comment under the same name with _comment. Answer with one JSON object.\n" + asked
    if seed is None:
        return F.concat(F.lit(head), body)
    return F.concat(F.lit(head), F.when(seed.isNotNull(), F.lit("\n" + more)).otherwise(""), body, F.when(seed.isNotNull(), F.concat(F.lit("\n\nSEED\n"), seed)).otherwise(""))


def correspondence(system: Column, seed_type: Column, seed: Column, statement: Column) -> Column:
    """Asks only how far a problem corresponds to its seed; the system prompt's beginning is context, never data."""
    how = F.when(seed_type == "example", "Compare form and difficulty; the subject should differ.").otherwise("Compare content; the adapted problem should follow from the seed.")
    return F.concat(F.lit("Grade seed_correspondence from 0 to 100 as JSON. "), how, F.lit("\n\nINSTRUCTIONS OF THE GENERATION\n"), or_empty(T.shortened(system, MOST_SYSTEM)), F.lit("\n\nSEED\n"), or_empty(seed), F.lit("\n\nPROBLEM\n"), or_empty(statement))


def described(code: Column) -> Column:
    """name(argument: type, ...) of the first function."""
    s = T.signature(code)
    return F.concat(s["name"], F.lit("("), F.array_join(F.transform(s["args"], lambda a: F.concat(a["name"], F.lit(": "), a["type"])), ", "), F.lit(")"))


def test_cases(code: Column, count: int = 5) -> Column:
    return F.concat(F.lit(f"Write {count} test cases as JSON {{\"test_cases\": [{{\"inputs\": {{...}}}}]}} for\n"), or_empty(described(code)), F.lit("\n\n"), or_empty(code))


def repair(code: Column, error: Column, reviews: Column | None = None) -> Column:
    """Asks for the function again, with what went wrong and what reviewers said (an array, may be null)."""
    said = F.lit("") if reviews is None else F.when(F.coalesce(F.size(reviews), F.lit(0)) > 0, F.concat(F.lit("\n\nREVIEWS\n"), T.numbered_list(reviews))).otherwise("")
    return F.concat(F.lit("Correct the function; keep its name and arguments. Answer with one python fence.\n"), or_empty(described(code)), F.lit("\n\nERROR\n"), F.coalesce(error, F.lit("none")), said, F.lit("\n\nCODE\n"), or_empty(code))


def solving(statement: Column, requirements: Column, code: Column, attempt: Column, reasoning: Column | None = None) -> Column:
    """Asks for an answer as a function of the reference's signature; ``reasoning`` sets an effort where it is not null."""
    lead = F.lit("") if reasoning is None else F.coalesce(F.concat(F.lit("Reasoning: "), reasoning, F.lit("\n")), F.lit(""))
    return F.concat(lead, or_empty(statement), F.lit("\n\n"), or_empty(requirements), F.lit("\n\nGive a python function "), F.coalesce(described(code), F.lit("f")), F.lit(" in a fence.\nAttempt "), attempt.cast("string"))
