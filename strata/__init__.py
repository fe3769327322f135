"""strata: cohort analytics, data-quality checks, dataset overlap audits and
classifier training/scoring, expressed as Spark DataFrame / SQL operators.

Layout
------
sources/    readers, writers, SQL catalog, named-query runner, manifests
functions/  pure Column expressions (feature extraction, text keys, binning)
operators/  DataFrame -> DataFrame operators (cohort profiles, describe,
            quality, filters, overlap, ML preparation / evaluation / scoring)
plans/      end-to-end jobs composed from operators, plus the driver testbed
presets/    the canonical passenger schema and its 20 named SQL analyses
streaming/  incremental scoring of newly arriving files
"""

__version__ = "0.1.0"
