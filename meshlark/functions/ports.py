"""Service ports: which side of a packet is the service, and what the port is called."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Port numbers and the service names that results must carry.
_SERVICES = """
7 Echo
20 FTP-data
21 FTP
22 SSH
23 Telnet
25 SMTP
43 WHOIS
53 DNS
67 DHCP-server
68 DHCP-client
69 TFTP
80 HTTP
88 Kerberos
110 POP3
111 RPCbind
119 NNTP
123 NTP
135 MS-RPC
137 NetBIOS-NS
138 NetBIOS-DGM
139 NetBIOS-SSN
143 IMAP
161 SNMP
162 SNMP-trap
179 BGP
194 IRC
389 LDAP
443 HTTPS
445 SMB
464 Kerberos-pw
465 SMTPS
500 ISAKMP
514 Syslog
515 LPD
520 RIP
530 RPC
543 Klogin
544 Kshell
546 DHCPv6-client
547 DHCPv6-server
554 RTSP
587 Submission
593 MS-DCOM
631 IPP
636 LDAPS
691 MS-Exchange
749 Kerberos-admin
853 DNS-over-TLS
873 rsync
902 VMware
993 IMAPS
995 POP3S
1080 SOCKS
1194 OpenVPN
1433 MS-SQL
1434 MS-SQL-Browser
1521 Oracle
1723 PPTP
1883 MQTT
2049 NFS
2181 ZooKeeper
2375 Docker
2376 Docker-TLS
3000 Grafana
3306 MySQL
3389 RDP
3478 STUN
4443 Pharos
4500 IPsec-NAT
5000 UPnP
5060 SIP
5061 SIP-TLS
5222 XMPP
5228 Google-Play
5353 mDNS
5432 PostgreSQL
5671 AMQP-TLS
5672 AMQP
5900 VNC
5984 CouchDB
6379 Redis
6443 Kubernetes
6514 Syslog-TLS
6660 IRC-alt
6667 IRC
6697 IRC-TLS
7001 WebLogic
7474 Neo4j
7687 Bolt
8000 HTTP-alt
8080 HTTP-proxy
8081 HTTP-alt2
8443 HTTPS-alt
8500 Consul
8883 MQTT-TLS
8888 HTTP-alt3
9000 SonarQube
9042 Cassandra
9090 Prometheus
9092 Kafka
9200 Elasticsearch
9300 ES-transport
9418 Git
10000 Webmin
11211 Memcached
15672 RabbitMQ-mgmt
27017 MongoDB
27018 MongoDB-shard
27019 MongoDB-config
50000 SAP
"""

SERVICE_NAMES: dict[int, str] = {
    int(port): name for port, name in (line.split(" ", 1) for line in _SERVICES.strip().splitlines())
}
PRIVILEGED_BELOW = 1024


def _port(value) -> Column:
    return (value if isinstance(value, Column) else F.lit(value)).cast("int")


def classify_service_port(src_port, dst_port) -> Column:
    """Service port of a (source, destination) pair; NULL if either is NULL.

    A privileged port beats an unprivileged one, otherwise a listed port beats an unlisted one, otherwise the
    smaller number is taken. Arguments are columns or constants.
    """
    src, dst = _port(src_port), _port(dst_port)
    privileged = [p < PRIVILEGED_BELOW for p in (src, dst)]
    listed = [p.isin(list(SERVICE_NAMES)) for p in (src, dst)]

    def lone(flags: list[Column]) -> Column:
        return F.when(flags[0] & ~flags[1], src).when(flags[1] & ~flags[0], dst)

    chosen = F.coalesce(lone(privileged), lone(listed), F.least(src, dst))
    return F.when(src.isNotNull() & dst.isNotNull(), chosen)


def port_service_name(port) -> Column:
    """Service name of a port; NULL when it is not listed."""
    names = F.create_map(*[F.lit(x) for pair in SERVICE_NAMES.items() for x in pair])
    return F.try_element_at(names, _port(port))


def service_table(spark: SparkSession) -> DataFrame:
    """The list as a DataFrame ``(service_port, service_name)``. Fixed size, safe to broadcast."""
    rows = ", ".join(f"({port}, '{name}')" for port, name in SERVICE_NAMES.items())
    return spark.sql(f"SELECT * FROM VALUES {rows} AS services(service_port, service_name)")


def with_service_name(df: DataFrame, port: str = "service_port", into: str = "service_name") -> DataFrame:
    """Add the service name by a broadcast join with the fixed list; an existing name is kept."""
    found = service_table(df.sparkSession).toDF(port, "_listed_name")
    named = df.join(F.broadcast(found), port, "left")
    kept = F.coalesce(F.col(into), F.col("_listed_name")) if into in df.columns else F.col("_listed_name")
    columns = list(df.columns) if into in df.columns else [*df.columns, into]
    return named.withColumn(into, kept).select(*columns)


def parsed_port(text: Column) -> Column:
    """Port text to int: decimals are cut off, anything else becomes NULL."""
    return text.try_cast("double").try_cast("int")
