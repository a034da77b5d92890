"""Column-expression and plan helpers shared by the operators.  Everything
here builds JVM-side Catalyst expressions or plain DataFrame plans (no
row-at-a-time Python)."""

from tabkit.functions.frames import fetch_row, materialize, with_scalars
from tabkit.functions.prefix import add_buckets, ordered_prefix_sums, prefix_sums_long
from tabkit.functions.scalar import (clip_col, hash_bucket, label_from_name,
                                     log1p_col, name_from_value, run_id_col, strip_ws)
from tabkit.functions.stats import null_safe_corr, sample_skewness

__all__ = ["clip_col", "hash_bucket", "label_from_name", "log1p_col", "name_from_value",
           "run_id_col", "strip_ws", "null_safe_corr", "sample_skewness", "add_buckets",
           "ordered_prefix_sums", "prefix_sums_long", "fetch_row", "materialize", "with_scalars"]
