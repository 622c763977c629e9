"""Deployment sheet specification: columns, types, roles and options (fixed values)."""

from __future__ import annotations

MIN_DATE = "1990-01-01 00:00:00"
EMPTY_MARKER = "Na"
EXPORT_MARKER = "NaN"
SHEET_COLUMNS = 38

OUTPUT_ORDER = (
    "RCV_PROJECT",
    "RECEIVER",
    "ACTIVATION_DATE_TIME",
    "STATION_NAME",
    "DEPLOY_DATE_TIME",
    "DEPLOY_LAT",
    "DEPLOY_LONG",
    "VALID_DATA_UNTIL_DATE_TIME",
    "RECOVER_DATE_TIME",
    "ACOUSTIC_RELEASE_NUMBER",
    "SPECIES_PREFERENCES",
    "ADDITIONAL_CLASSIFIER",
    "AMPLIFIER_SENSIVITY",
    "HYDROPHONE_SENSIVITY",
    "RECORDING_NAME",
    "HYDROPHONE_CABLE_LENGTH",
    "SAMPLE_RATE",
    "MOORING_TYPE",
    "BATTERY_END_DATE",
    "DOWNLOAD_DATE_TIME",
    "COMMENTS",
)
MANDATORY = (
    "RCV_PROJECT",
    "RECEIVER",
    "ACTIVATION_DATE_TIME",
    "STATION_NAME",
    "DEPLOY_DATE_TIME",
    "DEPLOY_LAT",
    "DEPLOY_LONG",
    "VALID_DATA_UNTIL_DATE_TIME",
)
DATETIMES = (
    "ACTIVATION_DATE_TIME",
    "DEPLOY_DATE_TIME",
    "VALID_DATA_UNTIL_DATE_TIME",
    "RECOVER_DATE_TIME",
    "BATTERY_END_DATE",
    "DOWNLOAD_DATE_TIME",
)
ROLES = {
    "ActivationDate": "ACTIVATION_DATE_TIME",
    "DeployDate": "DEPLOY_DATE_TIME",
    "Latitude": "DEPLOY_LAT",
    "Longitude": "DEPLOY_LONG",
    "ValidUntilDate": "VALID_DATA_UNTIL_DATE_TIME",
    "RecoverDate": "RECOVER_DATE_TIME",
    "BatteryEndDate": "BATTERY_END_DATE",
    "DownloadDate": "DOWNLOAD_DATE_TIME",
}
OPTIONS = {
    "SPECIES_PREFERENCES": ("No_Dolphins", "No_Sonar", "No_dolphins&Sonar", "NA"),
    "ADDITIONAL_CLASSIFIER": ("Default", "HEL1", "Genenc", "advancedKerno", "NA"),
    "MOORING_TYPE": ("surface-buoy", "surface-wind-turbine", "bottom-mooring"),
}
