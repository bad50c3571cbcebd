from staylens.functions.clean import (  # noqa: F401
    age_exact,
    age_year_boundary,
    category,
    drug_key,
    drug_name,
    elapsed,
    hash_bucket,
    hash_fraction,
    length_of_stay,
    number,
    sql_name,
    sql_text,
    timestamp,
    window_end,
)
