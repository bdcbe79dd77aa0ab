from starloom.functions.conform import (  # noqa: F401
    LOCAL_TZ, NULL_TS_DEFAULT, OPEN_END_DEFAULT, audit_ts, change_hash, date_key,
    hash_key, local_date, to_local, trimmed, ts_default,
)
