"""Native column expressions (no Python UDFs): time, scalar, hex grid."""
