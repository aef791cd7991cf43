"""riskspark.operators"""
