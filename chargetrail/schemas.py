"""Envelope, message bodies and the registry of message classes."""

from __future__ import annotations

from dataclasses import dataclass, field

# Column names and types of the messages and tables, message type codes, measurand.
EVENT_LOG = (
    "message_id string, message_type int, charge_point_id string, action string, "
    "write_timestamp string, body string"
)
START_REQUEST_BODY = (
    "connector_id int, id_tag string, meter_start int, timestamp string, reservation_id int"
)
START_RESPONSE_BODY = (
    "transaction_id int, id_tag_info struct<status:string, parent_id_tag:string, expiry_date:string>"
)
STOP_REQUEST_BODY = (
    "meter_stop int, timestamp string, transaction_id int, reason string, id_tag string, "
    "transaction_data array<string>"
)
METER_VALUES_BODY = (
    "connector_id int, transaction_id int, meter_value array<struct<timestamp:string, "
    "sampled_value:array<struct<value:string, context:string, format:string, measurand:string, "
    "phase:string, unit:string>>>>"
)
#: What the power of a transaction needs of a MeterValues body.
METER_POWER_BODY = (
    "transaction_id int, meter_value array<struct<timestamp:string, "
    "sampled_value:array<struct<value:string, measurand:string, phase:string>>>>"
)
STATUS_BODY = (
    "connector_id int, error_code string, status string, timestamp string, info string, "
    "vendor_id string, vendor_error_code string"
)
STATUS_CAMEL_CASE = {
    "connector_id": "connectorId",
    "error_code": "errorCode",
    "vendor_id": "vendorId",
    "vendor_error_code": "vendorErrorCode",
}
REQUEST, RESPONSE = 2, 3
TYPE_LABELS = {2: "Request", 3: "Response"}
IMPORT_POWER = "Power.Active.Import"
ENVELOPE = ["message_id", "message_type", "charge_point_id", "action", "write_timestamp"]
# End of fixed values.


@dataclass(frozen=True)
class MessageClass:
    """One kind of message: its action and type, the body's schema and how to flatten it."""

    action: str
    message_type: int
    body: str
    timestamps: tuple[str, ...] = ()
    other_names: dict[str, str] = field(default_factory=dict, hash=False)

    @property
    def table(self) -> str:
        return self.action + TYPE_LABELS[self.message_type]

    def wide_ids(self) -> "MessageClass":
        """The same class with 64-bit transaction ids and meter readings.

        The message standard has 32-bit fields; a value beyond them would read as NULL.
        """
        body = self.body
        for name in ("transaction_id", "meter_start", "meter_stop"):
            body = body.replace(f"{name} int", f"{name} bigint")
        return MessageClass(self.action, self.message_type, body, self.timestamps, self.other_names)


START_REQUEST = MessageClass("StartTransaction", REQUEST, START_REQUEST_BODY, ("timestamp",))
START_RESPONSE = MessageClass("StartTransaction", RESPONSE, START_RESPONSE_BODY)
STOP_REQUEST = MessageClass("StopTransaction", REQUEST, STOP_REQUEST_BODY, ("timestamp",))
METER_VALUES = MessageClass("MeterValues", REQUEST, METER_VALUES_BODY, ("timestamp",))
METER_POWER = MessageClass("MeterValues", REQUEST, METER_POWER_BODY, ("timestamp",))
STATUS = MessageClass("StatusNotification", REQUEST, STATUS_BODY, ("timestamp",), STATUS_CAMEL_CASE)

SILVER_CLASSES = (START_REQUEST, START_RESPONSE, STOP_REQUEST, METER_VALUES)

CDR_COLUMNS = [
    "charge_point_id",
    "transaction_id",
    "start_timestamp",
    "stop_timestamp",
    "total_time",
    "total_energy",
    "total_parking_time",
]
CDR_WIDE_COLUMNS = CDR_COLUMNS[:2] + ["meter_start", "meter_stop"] + CDR_COLUMNS[2:]
