"""CSV reports and the exchange file."""

import os

# File-name endings of the reports.
REPORTS = {"batch_summary": "_ActGroup_char_summary.csv", "data_summary": "_DataSummary.csv",
           "qc_summary": "_QCSummary.csv", "pair_scatter": "_QCplots.csv"}


def write_report(df, directory, report):
    """One folder of CSV per submission.

    The rebalance hint gathers each submission's rows and splits a submission that is too large
    for one task, so neither many small files nor one huge task comes of it.
    """
    path = os.path.join(directory, REPORTS[report].lstrip("_"))
    df.hint("rebalance", "subid").write.partitionBy("subid").option("nullValue", "NA").csv(path, header=True)
    return path


def write_exchange(df, path):
    """Exchange file: header, blank for missing."""
    df.write.option("nullValue", "").option("emptyValue", "").csv(path, header=True)
    return path
