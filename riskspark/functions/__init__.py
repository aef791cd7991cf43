"""riskspark.functions"""
