"""Flow-table schema: fixed names, class lists and the FlowSchema value."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, types as T

# ---------------------------------------------------------------------------
# These must equal the published flow-table layout.
# ---------------------------------------------------------------------------

# Raw CSV header names of the flow features, in file order.
RAW_FEATURES = [
    "Flow Duration", "Total Fwd Packets", "Total Backward Packets",
    "Total Length of Fwd Packets", "Total Length of Bwd Packets",
    "Fwd Packet Length Max", "Fwd Packet Length Min", "Fwd Packet Length Mean",
    "Fwd Packet Length Std", "Bwd Packet Length Max", "Bwd Packet Length Min",
    "Bwd Packet Length Mean", "Bwd Packet Length Std",
    "Flow Bytes/s", "Flow Packets/s",
    "Flow IAT Mean", "Flow IAT Std", "Flow IAT Max", "Flow IAT Min",
    "Fwd IAT Total", "Fwd IAT Mean", "Fwd IAT Std", "Fwd IAT Max", "Fwd IAT Min",
    "Bwd IAT Total", "Bwd IAT Mean", "Bwd IAT Std", "Bwd IAT Max", "Bwd IAT Min",
    "Fwd PSH Flags", "Bwd PSH Flags", "Fwd URG Flags", "Bwd URG Flags",
    "Fwd Header Length", "Bwd Header Length",
    "Fwd Packets/s", "Bwd Packets/s",
    "Min Packet Length", "Max Packet Length", "Packet Length Mean",
    "Packet Length Std", "Packet Length Variance",
    "FIN Flag Count", "SYN Flag Count", "RST Flag Count",
    "PSH Flag Count", "ACK Flag Count", "URG Flag Count",
    "CWE Flag Count", "ECE Flag Count",
    "Down/Up Ratio", "Average Packet Size", "Avg Fwd Segment Size",
    "Avg Bwd Segment Size", "Fwd Avg Bytes/Bulk", "Fwd Avg Packets/Bulk",
    "Fwd Avg Bulk Rate", "Bwd Avg Bytes/Bulk", "Bwd Avg Packets/Bulk",
    "Bwd Avg Bulk Rate",
    "Subflow Fwd Packets", "Subflow Fwd Bytes",
    "Subflow Bwd Packets", "Subflow Bwd Bytes",
    "Init_Win_bytes_forward", "Init_Win_bytes_backward",
    "act_data_pkt_fwd", "min_seg_size_forward",
    "Active Mean", "Active Std", "Active Max", "Active Min",
    "Idle Mean", "Idle Std", "Idle Max", "Idle Min",
]

# Raw class -> attack family (paper pipeline).
LABEL_FAMILIES = {
    "BENIGN": "Benign",
    "PortScan": "PortScan",
    "DDoS": "DoS/DDoS",
    "DoS Hulk": "DoS/DDoS",
    "DoS GoldenEye": "DoS/DDoS",
    "DoS slowloris": "DoS/DDoS",
    "DoS Slowhttptest": "DoS/DDoS",
    "Heartbleed": "DoS/DDoS",
    "FTP-Patator": "Brute Force",
    "SSH-Patator": "Brute Force",
    "Bot": "Botnet ARES",
    "Web Attack - Brute Force": "Web Attack",
    "Web Attack - Sql Injection": "Web Attack",
    "Web Attack - XSS": "Web Attack",
    "Infiltration": "Infiltration",
}

# Capture files: (file name, day, content).
CAPTURE_FILES = [
    ("Monday-WorkingHours.pcap_ISCX.csv", "Monday", "Benign"),
    ("Tuesday-WorkingHours.pcap_ISCX.csv", "Tuesday", "Benign, FTP-Patator, SSH-Patator"),
    ("Wednesday-workingHours.pcap_ISCX.csv", "Wednesday", "Benign, DoS, Heartbleed"),
    ("Thursday-WorkingHours-Morning-WebAttacks.pcap_ISCX.csv", "Thursday", "Benign, Web Attacks"),
    ("Thursday-WorkingHours-Afternoon-Infilteration.pcap_ISCX.csv", "Thursday", "Benign, Infiltration"),
    ("Friday-WorkingHours-Morning.pcap_ISCX.csv", "Friday", "Benign, Bot"),
    ("Friday-WorkingHours-Afternoon-PortScan.pcap_ISCX.csv", "Friday", "Benign, PortScan"),
    ("Friday-WorkingHours-Afternoon-DDos.pcap_ISCX.csv", "Friday", "Benign, DDoS"),
]

BENIGN = "BENIGN"
# Columns never treated as features (label encodings and capture day).
NON_FEATURES = ("Label", "Binary_Label", "Multi_Label", "Day",
                "label", "binary_label", "multi_label", "day", "label_category")
# ---------------------------------------------------------------------------


def snake_name(column: str) -> str:
    """Paper-pipeline column naming: trim blanks, '/' and ' ' to '_', lower case."""
    return column.strip(" ").replace("/", "_").replace(" ", "_").lower()


@dataclass(frozen=True)
class FlowSchema:
    """Names of the roles columns play; passed explicitly to every operator."""

    features: tuple[str, ...]
    label: str = "label"
    day: str | None = "day"
    row_id: str | None = "row_id"
    extra: tuple[str, ...] = field(default_factory=tuple)

    def with_features(self, features) -> "FlowSchema":
        return replace(self, features=tuple(features))

    @property
    def all_columns(self) -> list[str]:
        cols = list(self.features) + [self.label]
        if self.day:
            cols.append(self.day)
        return cols


#: Header line of the published files (features, then the label), for reads that declare it.
RAW_HEADER = ",".join([*RAW_FEATURES, "Label"])
