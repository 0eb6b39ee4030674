"""Names shared by the jobs."""

# Topic names of the channels and the comment result, in the
# reference's naming.
TOPIC_DB = "topic_db"
TOPIC_LOG = "topic_log"
CHANNEL_TOPICS = {
    "start": "dwd_traffic_start",
    "err": "dwd_traffic_err",
    "page": "dwd_traffic_page",
    "action": "dwd_traffic_action",
    "display": "dwd_traffic_display",
}
TOPIC_COMMENT_INFO = "dwd_interaction_comment_info"

# Settings of the reference's jobs (settings, not results).
CHECKPOINT_INTERVAL = "5 seconds"
