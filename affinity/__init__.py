"""Rating analytics and product recommendation on PySpark.

Every operator is a function from DataFrame to DataFrame. Reading and writing
lives in ``sources`` and ``streaming``; ``plans`` puts operators together.
"""
