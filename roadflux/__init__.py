"""Spark-native engine from raw GPS pings to vehicle-emission inventories."""
