"""Spark-native building blocks for fine-tuning data: lazy DataFrame stages composed by Catalyst."""
