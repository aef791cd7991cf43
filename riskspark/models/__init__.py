"""riskspark.models"""
