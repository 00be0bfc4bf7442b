"""Values that results depend on. They are data, not logic."""

# The six places an address can map to, by 0-based index.
COUNTRIES = ["United States", "India", "Germany", "Brazil", "Japan", "UK"]
CITIES = ["New York", "Mumbai", "Berlin", "São Paulo", "Tokyo", "London"]

# The address that marks an unusable log row, and the prefix of customer accounts.
BAD_IP = "bad_ip_address"
CUSTOMER_PREFIX = "cust"
CUSTOMER_NUMBER = r"cust(\d+)"

# Device names in order of precedence, with the substring that selects each.
MOBILE, TABLET, DESKTOP = "Mobile", "Tablet", "Desktop"
MOBILE_MARK, TABLET_MARK = "%Mobile%", "%iPad%"

# Source name and reason of every reject set.
SALES_SOURCE, SALES_REASON = "B2B Sales", "Negative Value"
WEBLOG_SOURCE, WEBLOG_REASON = "Weblogs", "Invalid IP"
LEAD_SOURCE, LEAD_REASON = "Marketing Leads", "Invalid Email/Score/Company"

# Origin given to uploaded leads, separator of the row hash.
LEADS_ORIGIN = "manual_upload"
HASH_SEPARATOR = "||"

# Combined access-log format and the time formats inside it. (?dU) makes `.`, `$`, `\s`, `\S` and `\d` treat
# line ends and non-ASCII text the way the log producer's tools do.
LOG_LINE = (
    r'(?dU)^(\S+)\s+\S+\s+(\S+)\s+\[(.*?)\]\s+"(.*?)"\s+(\d{3})\s+(\S+)\s+"(.*?)"\s+"(.*?)"$'
)
LOG_TIMES = ["d/MMM/yyyy:H:m:s Z", "d/MMM/yyyy:H:m:s XXX"]

# Names of the load and of its three layers, and the states a layer or batch can be in.
LOAD_NAME = "daily_load"
BRONZE, SILVER, GOLD = "bronze_ingestion_layer", "silver_cleansing_layer", "gold_star_schema_layer"
LAYERS = [BRONZE, SILVER, GOLD]
PENDING, RUNNING, SUCCESS, FAILED = "PENDING", "RUNNING", "SUCCESS", "FAILED"
ERROR_LENGTH = 255
