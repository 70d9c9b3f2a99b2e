"""Writers: stage tables, clean reads, feature matrix, labelled result and done marks."""
from cohortqc.sinks.writers import (  # noqa: F401
    fastq_text, mark_done, order_breaks, write_batch, write_clean_fastq, write_done_list, write_features, write_result_csv,
    sorted_files, write_sorted, write_stage, write_status,
)
