"""External-data preparation job: harmonize the external source, audit its
overlap with the training data, remove overlapping rows, summarize, write
the artifacts."""

from __future__ import annotations

import json
import os
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators import harmonize as H
from strata.operators import overlap as O
from strata.operators import quality as Q
from strata.session import cut_lineage
from strata.sources import io as IO

LISTED = 1_000  # rows of the class filter table in the run's summary


@dataclass
class ExternalPreparation:
    clean: DataFrame
    audit: DataFrame
    nonoverlap: DataFrame
    summary: dict


def summarize(clean: DataFrame, audit: DataFrame, training_rows: int, filter_summary: DataFrame, rule: str) -> dict:
    """Counts for the run summary: one overlap aggregate, one class
    before/after group-by, the class filter table and missing values of the
    kept rows (all small results)."""
    overlap = O.overlap_summary(audit, training_rows, rule).first().asDict()
    classes = {str(r.Pclass): {"before": r.rows_before, "after": r.rows_after}
               for r in O.class_counts_before_after(audit, rule).collect()}
    # excluded classes are free text: the most frequent are listed, the table of all is an artifact
    filters = [r.asDict() for r in filter_summary.orderBy(F.col("metric") == "excluded_class_rows", F.desc("value"), "key")
               .limit(LISTED).collect()]
    kept = O.nonoverlap(audit, rule)
    missing = {r.column: r.missing_count for r in Q.missing_profile(kept).collect()}
    return {"overlap_rule": rule, **overlap, "class_counts": classes, "class_filter": filters,
            "missing_after_removal": missing}


def prepare_external(external: DataFrame, training: DataFrame, *, rule: str = "either",
                     spec: H.ExternalSpec = H.ExternalSpec(), training_id: str = "PassengerId",
                     output_dir: str | None = None) -> ExternalPreparation:
    O.overlap_mask(rule)  # unknown rules fail before any job runs
    Q.require_columns(training, ["Name", "Ticket"], "training data")
    clean = H.harmonize_external(external, spec)
    # harmonized and audited once; the summaries and writes below read the cut tables
    clean = cut_lineage(clean)
    audit = cut_lineage(O.audit_overlap(clean, training, training_id=training_id, with_ids=False))
    kept = O.nonoverlap(audit, rule)
    n_train = training.count()
    summary = summarize(clean, audit, n_train, H.class_filter_summary(external, spec), rule)
    if output_dir:
        clean.write.mode("overwrite").parquet(os.path.join(output_dir, "external_clean"))
        kept.write.mode("overwrite").parquet(os.path.join(output_dir, "external_nonoverlap"))
        IO.write_csv(audit, os.path.join(output_dir, "overlap_audit"))
        IO.write_csv(H.class_filter_summary(external, spec), os.path.join(output_dir, "class_filter"))
        IO.write_text_file(external.sparkSession, os.path.join(output_dir, "external_overlap_summary.json"),
                        json.dumps(summary, indent=2, default=str))
    return ExternalPreparation(clean, audit, kept, summary)
