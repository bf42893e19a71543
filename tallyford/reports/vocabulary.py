"""Values found in the event data."""

# What the reports look for in events.
UNKNOWN = "unknown"
MESSAGE_APP = "conv"
CALL_APP = "locus"
METRICS_APP = "metrics"
IGNORED_AGENTS = ["Messenger", "Hydra", "UCConnector"]
BRIDGE_AGENT = "UCConnector"
CALL_ENDED = "TERMINATED"
MEETING_TYPES = ["CMRMEETING", "SPACEMEETING", "EVENTCENTERMEETING"]
NOT_COUNTED_LOCUS_TYPES = ["JABBER", "CMRMEETING", "EVENTCENTERMEETING", "SPACEMEETING"]
NOT_COUNTED_DEVICES = ["SIP", "TP_ENDPOINT"]
SHARE_DEVICE = "SPARK_SHARE"
AUDIO_END = "callEnd_audio"
VIDEO_END = "callEnd_video"
DESKTOP_AGENTS = ["sparkwindows", "sparkmac"]
ROOM_AGENTS = ["ce", "SparkBoard"]
SYSTEM_INFO_KEYS = ["sysinfo_darling", "sysinfo"]
MODEL_NAMES = {"Room 70D": "Undefined", "SparkBoard 55": "SPARK-BOARD55"}
SOURCE = "Spark"
STAMP = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
MIN_CALL_MS = 10000
GOOD_JITTER, GOOD_RTT, GOOD_LOSS = 150, 400, 5
TOP_USERS = 30
