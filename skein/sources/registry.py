"""The source files: exact headers, and how each field is converted."""

from __future__ import annotations

# File names and exact headers of the twelve source kinds.
HEADERS = {
    "01_Station.csv": ["Station_ID", "Station_Type", "Station_Name", "Station_Voltage_Level", "Station_Lon", "Station_Lat"],
    "02_Bus.csv": ["Bus_ID", "Bus_Name", "Bus_BaseKV", "Bus_Phase", "Bus_Station_ID", "Bus_IsSource"],
    "03_Switch.csv": ["Switch_ID", "Switch_FromBus", "Switch_ToBus", "Switch_Phase", "Switch_NormalState", "Switch_IsTie", "Switch_RatedCurrent_A", "Switch_HasMeasurement", "Switch_Meas_I_A", "Switch_Meas_P_kW", "Switch_Meas_Q_kVAR", "Switch_Meas_Timestamp"],
    "04_Disconnector.csv": ["Disconnector_ID", "Disconnector_FromBus", "Disconnector_ToBus", "Disconnector_NormalState"],
    "05_Feeder.csv": ["Feeder_ID", "Feeder_Name", "Feeder_SourceBus"],
    "06_EarthingSwitch.csv": ["EarthingSwitch_ID", "EarthingSwitch_Bus", "EarthingSwitch_State"],
    "07_AccessPoint.csv": ["AccessPoint_ID", "AccessPoint_Bus", "AccessPoint_Phase", "AccessPoint_UserType", "AccessPoint_ContractCapacity_kVA"],
    "08_Line.csv": ["Line_ID", "Line_FromBus", "Line_ToBus", "Line_Phase", "Line_Type", "Line_Model", "Line_Length_km", "Line_R1_ohm_per_km", "Line_X1_ohm_per_km", "Line_NumCircuits"],
    "09_Transformer.csv": ["Transformer_ID", "Transformer_FromBus", "Transformer_ToBus", "Transformer_Phase", "Transformer_RatedCapacity_kVA", "Transformer_HighVoltage_kV", "Transformer_LowVoltage_kV", "Transformer_R_pct", "Transformer_X_pct", "Transformer_ConnHV", "Transformer_ConnLV", "Transformer_NumTaps", "Transformer_TapRange"],
    "10_Load.csv": ["Load_ID", "Load_Bus", "Load_Phase", "Load_P_kW", "Load_Q_kVAR", "Load_PF"],
    "11_DER.csv": ["DER_ID", "DER_Bus", "DER_Phase", "DER_Type", "DER_RatedCapacity_kVA", "DER_RatedPower_kW", "DER_PF", "DER_ConnType", "DER_ControlMode"],
    "12_SimConfig.csv": ["Config_Key", "Config_Value"],
}

#: Converters by the ending of a field's name; the longest ending that fits counts, and other fields are text.
BY_ENDING = {
    "_BaseKV": "positive", "_Voltage_Level": "positive", "_HighVoltage_kV": "positive", "_LowVoltage_kV": "positive", "_Length_km": "positive", "_RatedCurrent_A": "positive", "Transformer_RatedCapacity_kVA": "positive",
    "_ContractCapacity_kVA": "nonnegative", "DER_RatedCapacity_kVA": "nonnegative", "_RatedPower_kW": "nonnegative", "_PF": "factor",
    "_Lon": "number", "_Lat": "number", "_R1_ohm_per_km": "number", "_X1_ohm_per_km": "number", "_R_pct": "number", "_X_pct": "number", "_P_kW": "number", "_Q_kVAR": "number", "_Meas_I_A": "number",
    "_NumCircuits": "integer", "_NumTaps": "integer", "_IsSource": "boolean", "_IsTie": "boolean", "_HasMeasurement": "boolean", "_NormalState": "state", "EarthingSwitch_State": "state",
    "_Phase": "phase", "_ID": "identifier", "_FromBus": "reference", "_ToBus": "reference", "_Bus": "reference", "_SourceBus": "reference", "_Station_ID": "reference",
}


def header(file: str) -> list[str]:
    return list(HEADERS[file])


def headers() -> dict[str, list[str]]:
    return {f: header(f) for f in HEADERS}


def converter(field: str) -> str:
    fits = [e for e in BY_ENDING if field.endswith(e)]
    return BY_ENDING[max(fits, key=len)] if fits else "text"


def key_of(file: str) -> str:
    """The field that identifies a row: the first."""
    return header(file)[0]


def reference_fields(file: str) -> list[str]:
    return [f for f in header(file)[1:] if converter(f) == "reference"]
