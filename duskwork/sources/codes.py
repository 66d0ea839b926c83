"""Fixed values the maintained tables depend on.

Every literal below is stored in, or compared with, table data; changing one
changes results.
"""

# --- fixed values: statuses and flags ---
PENDING = "PND"
EXPIRED = "EXP"
COMPLETED = "CMP"
TRANSACTION_TYPE = "TRA"
ORDERED = "ORD"
SUCCEEDED = "SUC"
ACTIVE = "A"
INACTIVE = "I"
RESET = "R"
DORMANT = "D"
YES = "Y"
NO = "N"

# --- fixed values: user and role types ---
INTERNAL_USER = "I"
EXTERNAL_USER = "E"
ROLE_SYSTEM = "S"
ROLE_ADVISER = "V"
ROLE_INVESTOR = "I"
INVESTOR_ROLE_NAME = "INVESTOR"

# --- fixed values: contracts ---
ACTIVE_CONTRACT = ("AC", "IF")
FRONT_END_COMPANIES = ("2", "3")
VALID_CONTRACT = "1"
OPEN_END = "99999999"

# --- fixed values: customer entities ---
CORPORATE_CLIENT = "C"
INDIVIDUAL = "IND"
CORPORATE = "COR"
JOINT = "JOI"
FIRST_OWNER = "JO1"
SECOND_OWNER = "JO2"
NO_ENTITY = -999
AUTHORITY = (("A", "AND"), ("J", "JUV"), ("O", "OR"))

# --- fixed values: run log and audit trail ---
PROCESS_USER = "EOD_PROCESS"
INTAKE_USER = "EOD-NEWFE"
MAIL_USER = "EOD-MASSMAILER"
AUDIT_TYPE = "E"
SUCCESS = "S"
FAILURE = "F"
MARK_OVERLAP_DAYS = 5

# --- fixed values: explanatory notes and transaction descriptions ---
ITEM_PREFIX = "IT"
ITEM_COMPANIES = ("1", "2", "3", "7")
NOTE_COMPANIES = ("1", "2", "3")
MAIN_COVERAGE = "01"
MAIN_RIDER = "00"
NOTE_PATTERN_HEAD = "EX"
ANY_FREQUENCY = "**"
ANY_BATCH = "****"
NO_PREMIUM_INDICATOR = "-"
SEGMENT_WIDTH = 78
SEGMENT_CODE_WIDTH = 8
