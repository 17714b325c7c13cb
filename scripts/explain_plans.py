"""Print the physical plan trees (formatted explain, tree part) of the
headline queries: ``python scripts/explain_plans.py [sf_dir] > plans.txt``."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

KEYS = ["assemble_records", "byte_budget", "per_source_cap", "sample_n", "word_counts", "bpe_encode",
        "pack_stream", "window_batch", "ngram_eval", "best_so_far", "chat_pairs"]


def tree(df) -> str:
    text = df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    return text.split("\n\n")[0]


def main():
    from talewright.plans.catalog import QUERIES
    from talewright.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8, 16)
    for k in sys.argv[2:] or KEYS:
        print(f"### {k}\n```\n{tree(QUERIES[k](spark, sf_dir))}\n```\n")


if __name__ == "__main__":
    main()
