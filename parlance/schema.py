"""Schemas of the engine's tables, and the check that a frame has one of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

SCHEMAS = {
    "raw_message": "sourceMessageId string, officialRoomId string, corpId string, messageTime bigint, sender struct<easyUserId:string, identityType:string, officialUserId:string>, analysisText string, content string, semanticPayload struct<replyTo:struct<sourceMessageId:string>>, schemaVersion bigint, parserVersion bigint, standardType string",
    "month_index": "corp_id string, official_room_id string, file_month string, ndjson_object_key string, ndjson_position bigint, ndjson_record_count bigint, ndjson_last_append_time timestamp_ntz, file_status int, is_deleted int",
    "message": "msg_id string, room string, corp string, at timestamp_ntz, sender_id string, official_user_id string, sender_role string, msg_type string, text string, reply_to string",
    "event": "id bigint, corpid string, roomid string, source_msg_ids array<string>, first_msg_time timestamp_ntz, last_msg_time timestamp_ntz, first_agent_reply_time timestamp_ntz, occurred_on date, asker string, asker_role string, agents array<string>, first_responder string, summary string, last_msg_role string, followup_wait_max_sec int, event_type string, taxonomy_version string, source_messages array<struct<msg_id:string,at:string,sender_id:string,sender_role:string,text:string>>",
    "group_day": "corpid string, roomid string, dt date, msg_count int, sender_count int, event_count int, merchant_event_count int, unreplied_count int, first_reply_p50_sec int, first_reply_p90_sec int, extraction_status string, classification_status string, agent_accounts map<string,string>, fact_completed_time timestamp_ntz",
    "agent_day": "corpid string, room string, agent string, official_user_id string, dt date, event_type string, taxonomy_version string, event_count int",
    "agent_msg_day": "corpid string, room string, agent string, dt date, msg_count int",
    "taxonomy": "version string, type_id string, parent_name string, name string, description string",
    "run_failure": "run_date date, corpid string, roomid string, reason string, stage string, window_since date, window_until date, gmt_created_time timestamp_ntz",
    "rewrite_log": "run_date date, window_since date, window_until date, frozen_before date, rooms array<string>",
    "merchant_summary": "merchant_id decimal(20,0), merchant_name string, merchant_group_config_name string, business_manager_id decimal(20,0), business_manager_name string",
    "room_config": "corp_id string, official_room_id string, group_name string, merchant_id decimal(20,0), is_deleted int",
}


def schema(name: str) -> StructType:
    return StructType.fromDDL(SCHEMAS[name])


def schema_faults(df: DataFrame, name: str) -> list[str]:
    """What a frame lacks of a table: missing columns and columns of another type. Extra columns are allowed."""
    own = dict(df.dtypes)
    faults = []
    for f in schema(name).fields:
        if f.name not in own:
            faults.append(f"{f.name}: missing")
        elif own[f.name] != f.dataType.simpleString():
            faults.append(f"{f.name}: {own[f.name]} instead of {f.dataType.simpleString()}")
    return faults


def check_schema(df: DataFrame, name: str) -> DataFrame:
    if faults := schema_faults(df, name):
        raise ValueError(f"{name}: " + "; ".join(faults))
    return df
