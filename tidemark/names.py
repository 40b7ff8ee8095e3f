"""Names and constants that job definitions and readers of the output rely on."""

# Fixed values -----------------------------------------------------------------
ACTIVE_STATUS = "ACTIF"

# Channel -> the roles that count as the acting party.
CHANNEL_RULES = {
    "C2S": ("sender",),
    "O2C": ("receiver",),
    "C2C": ("sender", "receiver"),
}
# Job-definition key that may rename each channel.
CHANNEL_KEYS = {"channel_c2s": "C2S", "channel_o2c": "O2C", "channel_c2c": "C2C"}

# Logical column -> (key in the job definition, physical column when not mapped).
USER_COLUMNS = {
    "msisdn": ("msisdn", "user_msisdn"),
    "status": ("status", "user_status"),
}
TRANSACTION_COLUMNS = {
    "sender_msisdn": ("sndr_msisdn", "tra_sndr_msisdn"),
    "receiver_msisdn": ("rcvr_msisdn", "tra_receiver_msisdn"),
    "transaction_date": ("date", "tra_date"),
    "sender_category": ("sndr_category", "tra_sndr_category"),
    "receiver_category": ("rcvr_category", "tra_receiver_category"),
    "channel": ("channel", "tra_channel"),
}

USERS_SCHEMA = "msisdn string"
TRANSACTIONS_SCHEMA = (
    "sender_msisdn string, receiver_msisdn string, transaction_date timestamp, "
    "sender_category string, receiver_category string, channel string"
)

# Party event: who, when, in which category.
PARTY, TIME, CATEGORY = "msisdn", "event_date", "event_category"

# Published snapshot.
OUT_PARTY, OUT_TIME, OUT_CATEGORY = "party_id", "zb_last_transaction_date", "zb_user_category"
OUT_STATUS, OUT_DAY = "zb_user_status", "day"

# Progress table.
JOB, DONE, UPDATED = "job_identifier", "last_successfully_processed_date", "last_update_timestamp"
PROGRESS_SCHEMA = f"{JOB} string, {DONE} date, {UPDATED} timestamp"
# ------------------------------------------------------------------------------

ROLES = {
    "sender": ("sender_msisdn", "sender_category"),
    "receiver": ("receiver_msisdn", "receiver_category"),
}
