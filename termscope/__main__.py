"""``python -m termscope report|select|classify``: the three runs from the shell."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from termscope.plans.classification import tune_and_evaluate
from termscope.plans.feature_selection import select_terms, select_terms_by_presence
from termscope.plans.term_report import term_report
from termscope.sources.reviews import load_documents, load_keyed_documents
from termscope.sources.stopwords import load_stopwords


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="termscope")
    parser.add_argument("run", choices=["report", "select", "select-by-presence", "classify"])
    parser.add_argument("--input", nargs="+", required=True, help="JSON-lines review files")
    parser.add_argument("--stopwords", help="text file, one word per line")
    parser.add_argument("--output", required=True, help="folder to write to")
    parser.add_argument("--top", type=int, help="terms per category, or terms in all")
    args = parser.parse_args(argv)

    spark = SparkSession.builder.appName("termscope").getOrCreate()
    stopwords = load_stopwords(spark, args.stopwords) if args.stopwords else ()
    if args.run == "report":
        docs = load_documents(spark, args.input)
        term_report(docs, args.output, stopwords, args.top or 75)
    elif args.run == "select":
        docs = load_documents(spark, args.input)
        select_terms(docs, args.output, stopwords, args.top or 2000)
    elif args.run == "select-by-presence":
        docs = load_documents(spark, args.input)
        select_terms_by_presence(docs, args.output, stopwords, args.top or 2000)
    else:
        docs = load_keyed_documents(spark, args.input)
        tuned = tune_and_evaluate(docs, stopwords, output=args.output)
        print(f"best {tuned.best} test F1 {tuned.test_f1:.4f}")


if __name__ == "__main__":
    main()
