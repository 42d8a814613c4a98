"""Declared Spark schemas of every table the operators read or write."""

MESSAGES = "array<struct<role:string,content:string>>"

CHECK_SCHEMA = (
    "struct<type:string,required:array<string>,"
    "enums:map<string,array<string>>>"
)
CHECKS = f"array<struct<type:string,n:bigint,prefix:string,schema:{CHECK_SCHEMA}>>"

PROMPT_ITEM = f"id string, category string, prompt string, checks {CHECKS}, json_schema {CHECK_SCHEMA}"
SFT_ROW = "prompt string, response string"
DPO_ROW = "prompt string, chosen string, rejected string"
MESSAGE_PAIR = f"prompt string, chosen {MESSAGES}, rejected {MESSAGES}"
VARIANT_PAIR = "prompt variant, chosen variant, rejected variant"

# One result record for every check type; fields of other types stay null.
CHECK_RESULT = (
    "struct<type:string,pass:boolean,reason:string,found_count:bigint,"
    "found_type:string,expected:string,prefix:string,error:string,"
    "missing:array<string>,details:map<string,struct<found:string,allowed:array<string>>>,"
    "checked_lines:array<string>,required_checked:array<string>,"
    "enums_checked:map<string,array<string>>>"
)

RUBRIC = (
    "struct<instruction_following:int,helpfulness:int,truthfulness:int,"
    "tone:int,safety:int,overall:int,winner:string,notes:string>"
)

GENERATION = "id string, model string, variant string, raw string"
TOKEN_LOGP = (
    "pair_id string, model string, side string, pos bigint, "
    "is_prompt boolean, logp double"
)
